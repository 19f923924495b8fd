"""A10: source options from a properties file and/or ``key=value`` arguments.

Secrets are never logged; callers pass the dict straight to ``reader.options(**opts)``.
"""

from __future__ import annotations

from collections.abc import Iterable


def _parse_properties(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for raw in text.splitlines():
        line = raw.strip()
        if not line or line[0] in "#!":
            continue
        for sep in ("=", ":"):
            if sep in line:
                k, v = line.split(sep, 1)
                out[k.strip()] = v.strip()
                break
    return out


def load_options(path: str | None = None, args: Iterable[str] = (), **overrides) -> dict[str, str]:
    """Merge a properties file, ``--key=value`` / ``key=value`` arguments and keyword overrides
    (later wins)."""
    opts: dict[str, str] = {}
    if path:
        with open(path, encoding="utf-8") as fh:
            opts.update(_parse_properties(fh.read()))
    for a in args:
        a = a.lstrip("-")
        if "=" in a:
            k, v = a.split("=", 1)
            opts[k.strip()] = v.strip()
    opts.update({k: str(v) for k, v in overrides.items()})
    return opts


def kafka_reader_options(opts: dict[str, str], max_records_per_trigger: int | None = None) -> dict[str, str]:
    """Map plain client properties to Spark's Kafka source options.

    ``bootstrap.servers``/``topic``/``group.id`` become ``kafka.bootstrap.servers``,
    ``subscribe`` and ``kafka.group.id``; other client settings get the ``kafka.`` prefix.
    A per-poll cap becomes ``maxOffsetsPerTrigger``.
    """
    out: dict[str, str] = {}
    for k, v in opts.items():
        if k == "topic":
            out["subscribe"] = v
        elif k in ("subscribe", "subscribePattern", "assign", "startingOffsets", "endingOffsets",
                   "maxOffsetsPerTrigger", "failOnDataLoss", "minPartitions") or k.startswith("kafka."):
            out[k] = v
        else:
            out[f"kafka.{k}"] = v
    if max_records_per_trigger is not None:
        out["maxOffsetsPerTrigger"] = str(max_records_per_trigger)
    return out
