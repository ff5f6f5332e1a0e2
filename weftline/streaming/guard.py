"""The version guard over a stream of catalog changes (OP-55..57)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.operators.serving import CATALOG_CONTENT, catalog_constraint

BUCKETS = 64
CHANGE = "op string, change_sequence long, product_id long, category_id long, product_name string, price decimal(12,2), is_active boolean, updated_at string, catalog_version long"


class LastAccepted(StatefulProcessor):
    """Decides changes in the order of their numbers by the last accepted version of their product and its content, which is all the state there is."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accepted = handle.getMapState("accepted", "product string", "version long, content string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True).sort_values("nth", kind="stable")
        last: dict[str, tuple[int, str] | None] = {}
        decisions, changed = [], set()
        for product, decision, version, content in zip(frame["product"], frame.decision, frame.version, frame.content):
            if not decision:  # neither a delete nor against a constraint
                if product not in last:
                    last[product] = self.accepted.getValue((product,)) if self.accepted.containsKey((product,)) else None
                before = last[product]
                if before is None or version > before[0] or (version, content) == tuple(before):
                    decision = "ACCEPT"
                    last[product] = (int(version), content)
                    changed.add(product)
                else:
                    decision = "REJECT_VERSION_DECREASE" if version < before[0] else "REJECT_SAME_VERSION_CHANGED"
            decisions.append(decision)
        for product in changed:
            self.accepted.updateValue((product,), last[product])
        yield frame.assign(decision=decisions)[["payload", "decision"]]

    def close(self) -> None:
        pass


def guarded_stream(changes: DataFrame) -> DataFrame:
    """The decision for each change of a stream (op, change_sequence and the catalog's columns), equal to `serving.version_guard` over all of it if numbers ascend from batch to batch."""
    names = [c.split()[0] for c in CHANGE.split(", ")]
    rule = F.when(F.col("op") == "d", "REJECT_DELETE").when(catalog_constraint().isNotNull(), "REJECT_CONSTRAINT").otherwise("")
    product = F.coalesce(F.col("product_id").cast("string"), F.lit(""))
    content = F.to_json(F.struct(*CATALOG_CONTENT))
    rows = changes.select(
        F.pmod(F.xxhash64("product_id"), F.lit(BUCKETS)).alias("bucket"), product.alias("product"), F.coalesce("change_sequence", F.lit(-1)).alias("nth"), F.coalesce("catalog_version", F.lit(-1)).alias("version"),
        rule.alias("decision"), content.alias("content"), F.to_json(F.struct(*names)).alias("payload"),
    )
    decided = rows.groupBy("bucket").transformWithStateInPandas(LastAccepted(), "payload string, decision string", "Append", "None")
    return decided.select(F.from_json("payload", CHANGE).alias("c"), "decision").select("c.*", "decision")
