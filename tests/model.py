"""A brute-force, row-by-row Python model of Silver and Gold business metrics.

Used only by the property tests, on tiny random batches, as an oracle
independent of both Spark and SQL.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

MANDATORY = ["event_id", "event_timestamp", "event_type", "ingestion_timestamp",
             "session_id", "user_id"]
ORDER = ["ingestion_timestamp", "event_timestamp", "event_date", "event_type", "user_id",
         "platform", "product_id", "session_id", "traffic_source", "country", "device_type"]
LOW = {dt.datetime: dt.datetime.min, dt.date: dt.date.min, str: ""}


def _trim(x):
    return None if x is None else x.strip(" ")


def _ts(x):
    if x is None:
        return None
    try:
        return dt.datetime.fromisoformat(x.strip())
    except ValueError:
        return None


def _initcap(x):
    if x is None:
        return None
    return " ".join(w[:1].upper() + w[1:].lower() for w in x.split(" "))


def standardize(r):
    ets = _ts(r["event_timestamp"])
    up = lambda c: None if r[c] is None else _trim(r[c]).upper()
    low = lambda c: None if r[c] is None else _trim(r[c]).lower()
    return {
        "event_id": up("event_id"),
        "event_timestamp": ets,
        "event_date": ets.date() if ets else None,
        "event_type": low("event_type"),
        "user_id": up("user_id"),
        "ingestion_timestamp": _ts(r["ingestion_timestamp"]),
        "platform": low("platform"),
        "product_id": up("product_id"),
        "session_id": up("session_id"),
        "traffic_source": low("traffic_source"),
        "country": _initcap(_trim(r["country"])),
        "device_type": low("device_type"),
    }


def _rank(row):
    out = []
    for c in ORDER:
        v = row[c]
        out.append((0, "") if v is None else (1, v))
    return tuple(out)


def silver(bronze_rows):
    groups = defaultdict(list)
    for r in map(standardize, bronze_rows):
        groups[r["event_id"]].append(r)
    out = []
    for rows in groups.values():
        s = max(rows, key=_rank)
        if any(s[c] is None for c in MANDATORY):
            continue
        if s["event_type"] != "page_view" and s["product_id"] is None:
            continue
        s = dict(s)
        for c, v in (("country", "unknown"), ("device_type", "unknown"),
                     ("platform", "others"), ("traffic_source", "others")):
            if s[c] is None:
                s[c] = v
        out.append(s)
    return out


def _round2(x: float) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def _rate(n, d):
    return _round2(n * 100 / d) if d > 0 else 0.0


def business_metrics(silver_rows):
    g = defaultdict(list)
    for r in silver_rows:
        g[(r["event_date"], r["country"])].append(r)
    out = []
    for (d, c), rows in g.items():
        users = {r["user_id"] for r in rows if r["user_id"] is not None}
        sess = {r["session_id"] for r in rows if r["session_id"] is not None}

        def stage(t, rows=rows):
            return len({r["user_id"] for r in rows if r["event_type"] == t and r["user_id"]})

        pv, cart, chk, pur = (stage(t) for t in ("product_view", "add_to_cart", "checkout",
                                                 "purchase"))
        key = hashlib.sha256("|".join(x for x in (str(d), c) if x is not None).encode()).hexdigest()
        out.append((key, d, c, len(users), len(sess), len(rows), pv, cart, chk, pur,
                    _rate(cart, pv), _rate(chk, cart), _rate(pur, chk)))
    return out
