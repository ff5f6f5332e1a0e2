"""Personal data by a semi-Markov conditional random field (operator 4).

Exact patterns give the base spans. Beside them a semi-Markov CRF looks at
regions that may hold a number or an address: a region is cut into atoms (digit
runs, letter runs, a bracketed "at" or "dot" with its spaces, single other
characters); every segment of up to MAX_ATOMS atoms is scored as a
whole for each type (grouping of its digits, separators, checksum, ranges,
neighbours), and a dynamic program over the region chooses boundaries and types
together. Weights are fitted by conditional log-likelihood on a bounded sample of
regions whose gold segments are the base spans, once as they stand and once in
written forms that the patterns miss (no leading plus, "at" for @) or in forms
that are no entity (a part over 255, a wrong check digit). Atoms
outside all regions have no candidate segment, so leaving them out is exact.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import itertools
import math
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import read_table

KINDS = ("email", "ip", "card", "phone")
#: Most digits of a number. A segment has room for as many single digits, each behind three separators, and an opening.
MAX_DIGITS = 19
#: Longest segment in atoms; windows and steps used in fitting.
MAX_ATOMS, FIT_WINDOWS, EPOCHS = 4 * MAX_DIGITS + 4, 400, 12
#: Characters of a window, and of the longest that is sampled; scores that are remembered.
WINDOW, LONGEST, MAX_KNOWN = 300, 4096, 200_000
#: An added span needs this marginal probability of its segment.
CERTAIN = 0.6

# The patterns below match the same spans as the plain forms, leftmost and
# greedy, but take linear time on long runs of their own characters.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = x * 2 - 9 if x > 4 else x * 2
        total += x
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches, by start and then kind as listed."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((start, end, "email"))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = only_digits(m[0]) if m.end() - m.start() <= 64 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


_REGION = re.compile(r"[+(]*+[0-9](?:[ ().-]{0,3}+[0-9])*+")
_SPOKEN = re.compile(r" ?(?:@|\(at\)|\[at\]) ?")
_TAIL = re.compile(r"[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+| ?(?:\((?:at|dot)\)|\[(?:at|dot)\]) ?|.", re.S)
_MARK = re.compile(r"@|\(at\)|\[at\]")


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Parts of the text that have candidate segments: with 7 digits or more, or around a written or spoken @."""
    for m in _REGION.finditer(text):
        if enough(sum("0" <= c <= "9" for c in m[0]), m[0].count(".")):
            yield m.span()
    if "@" in text or "(at)" in text or "[at]" in text:
        end = 0
        for m in _SPOKEN.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start() and (tail := _TAIL.match(text, m.end())):
                end = tail.end()
                yield start, end


def enough(digits: int, dots: int) -> bool:
    """What a region, or a number in it, has at least."""
    return digits >= 7 or dots >= 3


def shape(n: int) -> str:
    return str(n) if n < 5 else f"{n // 2 * 2}"


def features(text: str, start: int, end: int) -> list[str]:
    """Names of what is seen of a whole segment and its two neighbours; empty where it can't be an entity."""
    span = text[start:end]
    if not (span[0].isalnum() or span[0] in "+(") or not span[-1].isalnum():
        return []
    left, right = text[start - 1 : start], text[end : end + 1]
    edge = ["L" + ("w" if left.isalnum() else "." if left in "+.-(" and left else "_"), "R" + ("w" if right.isalnum() else "." if right in "-(" and right else "_")]
    mark = _MARK.search(span)
    if mark:
        tld = re.split(r"[^A-Za-z0-9]+", span)[-1]
        return ["mail", "tld" + shape(len(tld)), "tldword" + str(tld.isalpha()), "dots" + str("." in span[mark.end() :] or "dot" in span[mark.end() :]), "user" + str(mark.start() > 0), *edge]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    if not enough(len(digits), span.count(".")) or len(digits) > MAX_DIGITS or re.search(r"[A-Za-z]", span):
        return []
    gaps = "".join(sorted(set(re.sub(r"[0-9+]", "", span))))
    out = ["n" + shape(len(digits)), "sep" + gaps, "groups" + "-".join(map(str, map(len, groups[-3:]))), f"g{min(len(groups), 6)}", *edge]
    out.append("plus" + str(span[0] == "+"))
    if len(digits) >= 12:
        out.append("luhn" + str(luhn(digits)))
    if len(groups) == 4 and gaps == ".":
        out.append("quad" + str(all(int(g) <= 255 for g in groups)))
    out.append("bal" + str(span.count("(") == span.count(")")))
    return out


def numbers_ending(text: str, bounds: list[int], j: int) -> Iterator[tuple[int, tuple]]:
    """(first atom, what is seen) of the numbers that end with atom j - 1, each from the one before with one atom more."""
    if text[bounds[j - 1]] not in "0123456789":
        return
    right = text[bounds[j] : bounds[j] + 1]
    edge = "w" if right.isalnum() else "." if right in "-(" and right else "_"
    lengths: tuple[int, ...] = ()  # of the last digit groups
    n = total = dots = balance = groups = 0
    gaps, quad = "", True
    for i in range(j - 1, max(-1, j - 1 - MAX_ATOMS), -1):
        a, b = bounds[i], bounds[i + 1]
        first = text[a]
        if first in "0123456789":
            if n + b - a > MAX_DIGITS:
                return
            groups += 1
            if groups < 4:
                lengths = (b - a, *lengths)
            for c in text[a:b][::-1]:
                d = ord(c) - 48
                total += (d * 2 - 9 if d > 4 else d * 2) if n % 2 else d
                n += 1
            quad = quad and groups < 5 and int(text[a:b]) <= 255
        elif b - a > 1 or first.isascii() and first.isalpha():
            return  # letters, or a bracketed word
        else:
            dots += first == "."
            balance += (first == "(") - (first == ")")
            if first != "+" and first not in gaps:
                gaps = "".join(sorted(gaps + first))
            if first not in "+(" and not first.isalnum():
                continue
        if n >= 7 or dots >= 3:
            left = text[a - 1 : a]
            before = "w" if left.isalnum() else "." if left in "+.-(" and left else "_"
            yield i, (n, gaps, lengths, groups, before, edge, first == "+", n >= 12 and total % 10 == 0, quad, balance == 0)


def number_features(seen: tuple) -> list[str]:
    n, gaps, lengths, groups, before, after, plus, checked, quad, balanced = seen
    out = ["n" + shape(n), "sep" + gaps, "groups" + "-".join(map(str, lengths)), f"g{min(groups, 6)}", "L" + before, "R" + after, f"plus{plus}"]
    if n >= 12:
        out.append(f"luhn{checked}")
    if groups == 4 and gaps == ".":
        out.append(f"quad{quad}")
    return [*out, f"bal{balanced}"]


class SemiMarkov:
    """Types over segments of atoms; weights by (type, feature), (type before, type) and type."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.w: dict[tuple[str, str], float] = defaultdict(float, weights or {})

    def atoms(self, text: str, start: int, end: int) -> list[int]:
        return [start, *(m.end() for m in _ATOM.finditer(text, start, end))]

    def ending(self, text: str, bounds: list[int], j: int, plain: bool) -> Iterator[tuple[int, str, list[str]]]:
        """The candidates (first atom, type, features) that end before bound j. Without a mark (`plain`) nothing but numbers can be found."""
        if plain:
            for i, seen in numbers_ending(text, bounds, j):
                for kind in KINDS[1:]:
                    yield i, kind, number_features(seen)
            return
        for i in range(max(0, j - MAX_ATOMS), j):
            if seen := features(text, bounds[i], bounds[j]):
                for kind in ("email",) if "mail" in seen else KINDS[1:]:
                    yield i, kind, seen

    def lattice(self, text: str, start: int, end: int):
        """Atom bounds and, by end atom, the candidates (first atom, type, features)."""
        bounds = self.atoms(text, start, end)
        plain = not _MARK.search(text, start, end)
        return bounds, [[], *(list(self.ending(text, bounds, j, plain)) for j in range(1, len(bounds)))]

    def score(self, kind: str, seen: list[str]) -> float:
        return self.w[kind, ""] + sum(self.w[kind, x] for x in seen)

    def forward(self, by_end, total=True):
        """For each atom and last type (index 0: none) the log sum of all labelings of what stands before."""
        alpha = np.full((len(by_end), len(KINDS) + 1), -np.inf)
        alpha[0, 0] = 0
        for j in range(1, len(by_end)):
            alpha[j, 0] = np.logaddexp.reduce(alpha[j - 1])
            for i, kind, seen in by_end[j]:
                k = KINDS.index(kind) + 1
                turns = [self.w[f"after{a}", kind] for a in range(len(KINDS) + 1)]
                alpha[j, k] = np.logaddexp(alpha[j, k], np.logaddexp.reduce(alpha[i] + turns) + self.score(kind, seen))
        return alpha

    def backward(self, by_end):
        n = len(by_end)
        beta = np.full((n, len(KINDS) + 1), -np.inf)
        beta[n - 1] = 0
        starts: list[list] = [[] for _ in range(n)]
        for j, found in enumerate(by_end):
            for i, kind, seen in found:
                starts[i].append((j, kind, seen))
        for i in range(n - 2, -1, -1):
            beta[i] = beta[i + 1, 0]
            for j, kind, seen in starts[i]:
                k = KINDS.index(kind) + 1
                turns = np.array([self.w[f"after{a}", kind] for a in range(len(KINDS) + 1)])
                beta[i] = np.logaddexp(beta[i], turns + self.score(kind, seen) + beta[j, k])
        return beta

    def marginals(self, by_end):
        """Probability of each candidate: ((first, end, type, features, by type before), p)."""
        alpha, beta = self.forward(by_end), self.backward(by_end)
        z = np.logaddexp.reduce(alpha[-1])
        for j, found in enumerate(by_end):
            for i, kind, seen in found:
                k = KINDS.index(kind) + 1
                turns = np.array([self.w[f"after{a}", kind] for a in range(len(KINDS) + 1)])
                each = np.exp(alpha[i] + turns + self.score(kind, seen) + beta[j, k] - z)
                yield i, j, kind, seen, each

    def fit(self, cases: list[tuple[str, int, int, set[tuple[int, int, str]]]], epochs: int = EPOCHS, rate: float = 0.5, decay: float = 1e-4) -> SemiMarkov:
        """Adagrad on the conditional log-likelihood of the gold segments of each region."""
        seen_sq: dict[tuple[str, str], float] = defaultdict(float)
        ready = [(self.lattice(text, a, b), gold) for text, a, b, gold in cases]
        for _ in range(epochs):
            for (bounds, by_end), gold in ready:
                slope: dict[tuple[str, str], float] = defaultdict(float)
                last = 0
                for i, j, kind, seen, each in self.marginals(by_end):
                    hit = (bounds[i], bounds[j], kind) in gold
                    d = hit - float(each.sum())
                    if abs(d) > 1e-4:
                        for x in ["", *seen]:
                            slope[kind, x] += d
                    for a, p in enumerate(each):
                        slope[f"after{a}", kind] += (hit and a == last) - p
                    if hit:
                        last = KINDS.index(kind) + 1
                for key, g in slope.items():
                    g -= decay * self.w[key]
                    seen_sq[key] += g * g
                    self.w[key] += rate * g / math.sqrt(seen_sq[key] + 1e-8)
        return self

    def decode(self, text: str, start: int, end: int) -> list[tuple[int, int, str]]:
        """Segments of the best labeling whose marginal probability is at least CERTAIN.

        Candidates are made as they are needed, once forwards and, if there is a
        segment at all, once backwards; what is held grows by a few numbers an atom.
        """
        bounds = self.atoms(text, start, end)
        plain = not _MARK.search(text, start, end)
        n, types = len(bounds), len(KINDS) + 1
        turns = [[self.w[f"after{a}", kind] for kind in KINDS] for a in range(types)]
        known: dict[tuple, list[float]] = {}

        def scores_of(key: tuple) -> list[float]:
            if key not in known:
                if len(known) >= MAX_KNOWN:
                    known.clear()
                seen = number_features(key) if plain else key
                known[key] = [self.score(k, seen) for k in KINDS]
            return known[key]

        def scored(j: int) -> Iterator[tuple[int, int, float]]:
            if plain:
                for i, key in numbers_ending(text, bounds, j):
                    _, ip, card, phone = scores_of(key)
                    yield i, 1, ip
                    yield i, 2, card
                    yield i, 3, phone
            else:
                for i, kind, seen in self.ending(text, bounds, j, plain):
                    k = KINDS.index(kind)
                    yield i, k, scores_of(tuple(seen))[k]

        empty = [-math.inf] * types
        first = [0.0] + empty[1:]
        # By bound: log sums and best scores by last type (0: none), and both again with the turn to each type after them.
        alpha, best = array("d", first), array("d", first)
        into, reach = array("d", turns[0]), array("d", turns[0])
        turned = bytearray(len(KINDS))  # type before, where the best comes from one
        origin, before = array("i", [0] * types), bytearray(types)
        some = False
        for j in range(1, n):
            low = types * (j - 1)
            prior = alpha[low : low + types]
            a = max(range(types), key=lambda x: best[low + x])
            row, top, come, last = empty[:], empty[:], [j - 1] * types, [a] * types
            row[0], top[0] = log_sum(prior), best[low + a]
            found: dict[int, list[float]] = {}
            for i, k, score in scored(j):
                some = True
                found.setdefault(k, []).append(into[len(KINDS) * i + k] + score)
                if (x := reach[len(KINDS) * i + k] + score) > top[k + 1]:
                    top[k + 1], come[k + 1], last[k + 1] = x, i, turned[len(KINDS) * i + k]
            for k, values in found.items():
                row[k + 1] = log_sum(values)
            alpha.extend(row), best.extend(top), origin.extend(come), before.extend(last)
            for k in range(len(KINDS)):
                into.append(log_sum([row[a] + turns[a][k] for a in range(types)]))
                a = max(range(types), key=lambda x: top[x] + turns[x][k])
                reach.append(top[a] + turns[a][k]), turned.append(a)
        if not some:
            return []
        chosen, j = [], n - 1
        k = max(range(types), key=lambda x: best[types * j + x])
        while j > 0:
            at = types * j + k
            if k:
                chosen.append((origin[at], j, k - 1))
            j, k = origin[at], before[at]
        if not chosen:
            return []
        z, out, wanted = log_sum(alpha[-types:]), [], {(i, j, k) for i, j, k in chosen}
        # Backwards the sums after a bound are of what starts there, by the type before it; a segment hands its own on to its start.
        held: dict[int, list[list[float]]] = {}
        after = [0.0] * types
        for j in range(n - 1, 0, -1):
            if j < n - 1:
                own = held.pop(j, None)
                after = [log_sum([after[0], *own[a]]) if own else after[0] for a in range(types)]
            for i, k, score in scored(j):
                lists = held.setdefault(i, [[] for _ in range(types)])
                for a in range(types):
                    lists[a].append(turns[a][k] + score + after[k + 1])
                if (i, j, k) in wanted and math.exp(into[len(KINDS) * i + k] + score + after[k + 1] - z) >= CERTAIN:
                    out.append((bounds[i], bounds[j], KINDS[k]))
        return out[::-1]


def log_sum(values) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(x - top) for x in values))


class Spans:
    """Spans by start, and the largest end up to each: what of them meets a stretch of text is found without a look at the others."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self.spans = sorted(spans)
        self.starts = [s for s, _, _ in self.spans]
        self.ends = list(itertools.accumulate((e for _, e, _ in self.spans), max))

    def covers(self, a: int, b: int) -> bool:
        """Whether one span holds a..b."""
        k = bisect.bisect_right(self.starts, a)
        return k > 0 and self.ends[k - 1] >= b

    def meets(self, a: int, b: int) -> bool:
        """Whether one span has a character of a..b."""
        k = bisect.bisect_left(self.starts, b)
        return k > 0 and self.ends[k - 1] > a

    def inside(self, a: int, b: int) -> list[tuple[int, int, str]]:
        return [x for x in self.spans[bisect.bisect_left(self.starts, a) : bisect.bisect_left(self.starts, b)] if x[1] <= b]

    def after(self, cut: int) -> int:
        """`cut`, or the end of the spans across it."""
        k = bisect.bisect_right(self.ends, cut)
        while k < len(self.spans) and self.starts[k] < cut:
            cut = max(cut, self.spans[k][1])
            k += 1
        return cut


def windows(text: str) -> Iterator[tuple[str, int, int, set[tuple[int, int, str]]]]:
    """(text, start, end, gold) of all regions, with some text around; long ones in parts of WINDOW characters or so, cut outside gold spans."""
    every = Spans(base_spans(text))
    for a, b in regions(text):
        gold = Spans(every.inside(a, b))
        while a < b:
            cut = b if b - a <= WINDOW else a + WINDOW
            if cut < b:
                cut = gold.after(cut)
                while cut < b and text[cut - 1].isalnum() and text[cut].isalnum():
                    cut += 1
            left = max(0, a - 20)
            yield text[left : cut + 20], a - left, cut - left, {(s - left, e - left, k) for s, e, k in gold.inside(a, cut)}
            a = cut


def training_cases(texts: list[str]) -> list[tuple[str, int, int, set[tuple[int, int, str]]]]:
    return [case for text in texts for window in windows(text) for case in written_forms(*window)]


def written_forms(text: str, a: int, b: int, gold: set[tuple[int, int, str]]) -> Iterator[tuple[str, int, int, set[tuple[int, int, str]]]]:
    """A region with its base spans as gold, and each span again in a written form that the patterns miss, or that is no entity."""
    yield text, a, b, gold
    for s, e, k in sorted(gold):
        left, span, right = text[max(0, s - 20) : s], text[s:e], text[e : e + 20]
        if k == "phone" and (m := re.match(r"\+[0-9]+[ .-]*", span)):
            span = span[m.end() :]
        elif k == "email":
            span = span.replace("@", " (at) ")
        else:  # out of range or with a wrong check digit it is none
            wrong = re.sub("[0-9]+$", "300", span) if k == "ip" else span[:-1] + str((int(span[-1]) + 5) % 10)
            yield left + wrong + right, len(left), len(left) + len(wrong), set()
            continue
        if len(only_digits(span)) >= 9 or k == "email":
            yield left + span + right, len(left), len(left) + len(span), {(len(left), len(left) + len(span), k)}


def fit_model(docs: DataFrame, fit_windows: int = FIT_WINDOWS) -> dict[tuple[str, str], float]:
    """Weights from at most `fit_windows` windows of regions, those with the smallest hashes of all documents' windows.

    A window of over LONGEST characters (one span without end) isn't sampled. Without any, all weights are 0 and nothing is added.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The task's windows of the smallest hashes, each once."""
        least: list[tuple[int, tuple]] = []
        held: set[int] = set()
        for batch in batches:
            for text in batch.column(0):
                for w in windows(text.as_py()):
                    row = (w[0], w[1], w[2], ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(w[3])))
                    rank = -int.from_bytes(hashlib.blake2b(repr(row).encode("utf-8", "surrogatepass"), digest_size=7).digest())
                    if len(w[0]) > LONGEST or rank in held or (len(least) == fit_windows and rank <= least[0][0]):
                        continue
                    held.add(rank)
                    if len(least) < fit_windows:
                        heapq.heappush(least, (rank, row))
                    else:
                        held.discard(heapq.heapreplace(least, (rank, row))[0])
        if least:
            names = ("text", "a", "b", "gold")
            yield pa.RecordBatch.from_pydict({"h": [-rank for rank, _ in least]} | {name: [row[k] for _, row in least] for k, name in enumerate(names)})

    some = docs.where(F.col("text").rlike("@|[(\\[]at[)\\]]|[0-9][ ().0-9-]{5,}[0-9]|[0-9]\\.[0-9]")).select("text").mapInArrow(run, "h long, text string, a long, b long, gold string")
    some = some.distinct().orderBy("h", "text", "a", "b", "gold").limit(fit_windows)
    cases = []
    for r in some.collect():
        gold = {(int(s), int(e), k) for k, s, e in (x.split(":") for x in r.gold.split(",") if x)}
        cases.extend(written_forms(r.text, r.a, r.b, gold))
    return {k: v for k, v in SemiMarkov().fit(cases).w.items() if abs(v) > 1e-6}


def find_pii(docs: DataFrame, weights: dict[tuple[str, str], float] | None = None) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, spans array<struct<start,end,kind,base>> by start and kind.

    Null text counts as empty. Offsets are code points, the end exclusive. Base
    spans of different kinds may overlap; an added span overlaps no other, the
    first of two that would stays. Repeated rows are searched each; an empty
    table gives no rows. Other columns are not read.
    """
    weights = fit_model(docs) if weights is None else weights
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(item))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SemiMarkov(weights)
        for batch in batches:
            spans = [all_spans(t.as_py() or "", model) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(spans, pa.list_(item))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, spans array<struct<start:long,end:long,kind:string,base:boolean>>")


_HINT = re.compile(r"[0-9@]|\((?:at)\)|\[at\]")


def all_spans(text: str, model: SemiMarkov) -> list[dict]:
    if not _HINT.search(text):
        return []
    base = base_spans(text)
    taken, added, last = Spans(base), 0, 0
    out = [(s, e, k, True) for s, e, k in base]
    for a, b in regions(text):
        if a < last:  # those around an @ begin anew
            taken, added = Spans([x[:3] for x in out]), 0
        last = a
        if taken.covers(a, b):
            continue
        for s, e, k in model.decode(text, a, b):
            if s >= added and not taken.meets(s, e):
                out.append((s, e, k, False))
                added = e
    out.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    return [{"start": s, "end": e, "kind": k, "base": own} for s, e, k, own in out]


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and base_sha256 are of base spans; spans has the added ones too, n_added says how many."""
    found = find_pii(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    added = (F.size("spans") - F.size(base)).cast("bigint").alias("n_added")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), added)
