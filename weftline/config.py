"""Settings, checked once and passed as arguments; transforms read no environment."""

from __future__ import annotations

from dataclasses import dataclass

BEHAVIORS = ("pv", "cart", "fav", "buy")
PROTOCOLS = ("PLAINTEXT", "SASL_SSL")


@dataclass(frozen=True)
class RuntimeConfig:
    """OP-63."""

    checkpoint_dir: str
    watermark_delay_ms: int = 5000
    dedup_retention_hours: int = 168
    checkpoint_interval_ms: int = 60_000
    cart_ttl_seconds: int = 604_800
    feature_ttl_seconds: int = 86_400
    bounded: bool = True
    flush_open_windows: bool = False
    #: Shards that the source has; those that haven't come hold windows open. A job that isn't bounded does without one that is silent for the idle timeout.
    shards: tuple[str, ...] = ()
    idle_timeout_ms: int = 30_000
    restart_attempts: int = 3
    restart_delay_ms: int = 10_000

    def __post_init__(self):
        if not self.checkpoint_dir.strip():
            raise ValueError("checkpoint_dir is required")
        for name in ("watermark_delay_ms", "dedup_retention_hours", "checkpoint_interval_ms", "cart_ttl_seconds", "feature_ttl_seconds", "idle_timeout_ms", "restart_attempts", "restart_delay_ms"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")


def kafka_options(servers: str, protocol: str = "PLAINTEXT", mechanism: str = "", username: str = "", password: str = "", jaas: str = "") -> dict[str, str]:
    """OP-13: reader and writer options; a partial SASL setting is an error. `jaas` is a whole JAAS setting and goes before user and password."""
    if protocol not in PROTOCOLS:
        raise ValueError(f"protocol must be one of {PROTOCOLS}")
    options = {"kafka.bootstrap.servers": servers, "kafka.security.protocol": protocol}
    given = [bool(x) for x in (mechanism, username, password, jaas)]
    if protocol == "PLAINTEXT":
        if any(given):
            raise ValueError("SASL settings need SASL_SSL")
        return options
    if not mechanism or bool(username) != bool(password) or not (password or jaas):
        raise ValueError("SASL_SSL needs a mechanism, and username and password or a JAAS setting")
    if jaas:
        return options | {"kafka.sasl.mechanism": mechanism, "kafka.sasl.jaas.config": jaas}
    quoted = [x.replace("\\", "\\\\").replace('"', '\\"') for x in (username, password)]
    module = "org.apache.kafka.common.security.plain.PlainLoginModule" if mechanism == "PLAIN" else "org.apache.kafka.common.security.scram.ScramLoginModule"
    return options | {"kafka.sasl.mechanism": mechanism, "kafka.sasl.jaas.config": f'{module} required username="{quoted[0]}" password="{quoted[1]}";'}
