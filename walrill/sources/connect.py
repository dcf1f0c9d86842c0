"""Settings from the environment, as options of Spark's own readers and writers."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


def env(name: str, fallback: str = "", source: Mapping[str, str] | None = None) -> str:
    """A trimmed setting, or the fallback if it is missing or blank."""
    return (source if source is not None else os.environ).get(name, "").strip() or fallback


def brokers(text: str) -> list[str]:
    return [x.strip() for x in text.split(",") if x.strip()]


@dataclass(frozen=True)
class Settings:
    source_dsn: str
    destination_dsn: str
    slot: str
    publication: str
    brokers: tuple[str, ...]
    topic: str
    group: str
    retention_seconds: float

    @staticmethod
    def load(source: Mapping[str, str] | None = None) -> Settings:
        get = lambda n, f="": env(n, f, source)
        text = get("RETENTION_SECONDS")
        try:
            retention = float(text) if text and float(text) > 0 else 604_800.0
        except ValueError:
            retention = 604_800.0
        return Settings(get("SOURCE_SQL_DSN"), get("DESTINATION_DSN"), get("PG_REPLICATION_SLOT", "cdc_slot"), get("PG_PUBLICATION", "cdc_publication"), tuple(brokers(get("KAFKA_BROKERS", "localhost:9092"))), get("KAFKA_TOPIC", "cdc.events"), get("KAFKA_CONSUMER_GROUP", "destination-writer"), retention)


def kafka_options(settings: Settings, source: Mapping[str, str] | None = None) -> dict[str, str]:
    """Broker and security options, for reading and writing."""
    get = lambda n: env(n, "", source)
    out = {"kafka.bootstrap.servers": ",".join(settings.brokers)}
    tls = get("KAFKA_TLS_ENABLED") == "true" or any(get(n) for n in ("KAFKA_CA_CERT", "KAFKA_CLIENT_CERT", "KAFKA_CLIENT_KEY"))
    user, password = get("KAFKA_SASL_USERNAME"), get("KAFKA_SASL_PASSWORD")
    sasl = bool(user and password)
    out["kafka.security.protocol"] = {(False, False): "PLAINTEXT", (True, False): "SSL", (False, True): "SASL_PLAINTEXT", (True, True): "SASL_SSL"}[tls, sasl]
    if get("KAFKA_CA_CERT"):
        out |= {"kafka.ssl.truststore.type": "PEM", "kafka.ssl.truststore.location": get("KAFKA_CA_CERT")}
    if get("KAFKA_CLIENT_CERT") and get("KAFKA_CLIENT_KEY"):
        out |= {"kafka.ssl.keystore.type": "PEM", "kafka.ssl.keystore.certificate.chain": get("KAFKA_CLIENT_CERT"), "kafka.ssl.keystore.key": get("KAFKA_CLIENT_KEY")}
    if sasl:
        quote = lambda x: x.replace("\\", "\\\\").replace('"', '\\"')
        mechanism = "SCRAM-SHA-512" if get("KAFKA_SASL_MECHANISM") == "SCRAM-SHA-512" else "SCRAM-SHA-256"
        out |= {"kafka.sasl.mechanism": mechanism, "kafka.sasl.jaas.config": f'org.apache.kafka.common.security.scram.ScramLoginModule required username="{quote(user)}" password="{quote(password)}";'}
    return out


def kafka_read_options(settings: Settings, source: Mapping[str, str] | None = None, per_batch: int = 1_000_000) -> dict[str, str]:
    """Earliest offsets first, bounded micro-batches, a loud end where the broker has lost data, 4 MiB a fetch."""
    return kafka_options(settings, source) | {"subscribe": settings.topic, "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": str(per_batch), "kafka.group.id": settings.group, "kafka.max.partition.fetch.bytes": str(4 << 20), "includeHeaders": "true"}


def kafka_write_options(settings: Settings, source: Mapping[str, str] | None = None) -> dict[str, str]:
    """Acknowledged by all replicas in sync."""
    return kafka_options(settings, source) | {"topic": settings.topic, "kafka.acks": "all", "kafka.enable.idempotence": "true", "includeHeaders": "true"}


#: What the topic must look like (fixed values).
TOPIC = {"partitions": 1, "replication": 3, "min.insync.replicas": 2, "retention.ms": 7 * 24 * 3600 * 1000}


def jdbc_options(dsn: str, source: Mapping[str, str] | None = None) -> dict[str, str]:
    """JDBC options of a postgres:// address; TLS settings of the environment come on top of those in it."""
    from urllib.parse import parse_qsl, unquote, urlsplit

    u = urlsplit(dsn)
    params = dict(parse_qsl(u.query))
    out = {"url": f"jdbc:postgresql://{u.hostname}:{u.port or 5432}{u.path}", "driver": "org.postgresql.Driver"}
    if u.username:
        out["user"] = unquote(u.username)
    if u.password:
        out["password"] = unquote(u.password)
    certificates = {"sslrootcert": env("PGSSLROOTCERT", "", source), "sslcert": env("PGSSLCERT", "", source), "sslkey": env("PGSSLKEY", "", source)}
    mode = env("PGSSLMODE", params.get("sslmode", ""), source)
    if not mode and any(certificates.values()):
        mode = "verify-full"
    if mode:
        out["sslmode"] = mode
    if mode != "disable":
        out |= {k: v for k, v in certificates.items() if v}
    return out
