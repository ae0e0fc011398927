"""Building blocks of the SQL counterparts (DuckDB dialect)."""

from __future__ import annotations

HISTORY_KEYS = ("card1", "addr1", "p_emaildomain")
FREQUENCY_KEYS = (*HISTORY_KEYS, "device_info")
MISSING = "'__MISSING__'"

_BLOCKS: dict[str, str] = {
    "txn": """
        SELECT o.o_orderkey AS transaction_id,
               date_diff('second', TIMESTAMP '1995-01-01', o.o_orderdate) AS transaction_dt,
               o.o_totalprice AS transaction_amt,
               CAST(CASE WHEN o.o_custkey % 29 = 0 AND (o.o_orderkey * 7919) % 1000 < 600 THEN 1
                         WHEN (o.o_orderkey * 7919) % 1000 < 15 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud,
               CASE WHEN o.o_orderkey % 17 <> 0 THEN CAST(o.o_custkey AS VARCHAR) END AS card1,
               CAST(c.c_nationkey AS VARCHAR) AS addr1,
               CASE WHEN o.o_orderkey % 11 <> 0 THEN o.o_orderpriority END AS p_emaildomain
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "idn": """
        SELECT e.event_id AS transaction_id,
               CASE WHEN e.event_id % 10 <> 0 THEN e.event_type END AS device_type,
               e.props AS device_info, e.value AS id_01, p.p_name AS id_30,
               p.p_type || ' ' || p.p_brand AS id_31
        FROM events e LEFT JOIN part p ON e.event_id % (SELECT count(*) FROM part) = p.p_partkey
        WHERE e.event_id % 3 <> 0""",
    "jnd": """
        SELECT t.*, i.device_type, i.device_info, i.id_01, i.id_30, i.id_31
        FROM txn t LEFT JOIN idn i ON t.transaction_id = i.transaction_id""",
    "bounds": """
        SELECT round(quantile_cont(CAST(transaction_dt AS DOUBLE), 0.7), 6) AS t1,
               round(quantile_cont(CAST(transaction_dt AS DOUBLE), 0.85), 6) AS t2
        FROM txn""",
    "sp": """
        SELECT j.*, CASE WHEN transaction_dt <= t1 THEN 'train' WHEN transaction_dt <= t2 THEN 'validation'
                         WHEN transaction_dt > t2 THEN 'holdout' END AS split
        FROM jnd j CROSS JOIN bounds""",
    "scored": """
        SELECT transaction_id, transaction_dt, split, is_fraud AS label,
               CAST((transaction_id * 7907) % 997 + 300 * is_fraud AS DOUBLE) / CAST(1297 AS DOUBLE) AS score
        FROM sp""",
    "duo": """
        SELECT 'candidate' AS model, split, label, score FROM scored
        UNION ALL
        SELECT 'baseline', split, label,
               CAST((transaction_id * 7901) % 997 AS DOUBLE) / CAST(1297 AS DOUBLE) FROM scored""",
}

CALENDAR_OF = """
    CAST(month({ts}) AS INTEGER) AS "DT_M", CAST(weekofyear({ts}) AS INTEGER) AS "DT_W",
    CAST(day({ts}) AS INTEGER) AS "DT_D", CAST(hour({ts}) AS INTEGER) AS hour,
    CAST(isodow({ts}) - 1 AS INTEGER) AS day_of_week,
    CAST(CASE WHEN isodow({ts}) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend"""
EVENT_TIME = "(TIMESTAMP '1995-01-01' + to_seconds(CAST(transaction_dt AS BIGINT)))"
CALENDAR = CALENDAR_OF.format(ts=EVENT_TIME)
_LOG = "ln(1 + greatest(transaction_amt, 0))"
_CENTS = "(transaction_amt - floor(transaction_amt)) * 100"
AMOUNT = f"round({_LOG}, 6) AS transaction_amt_log, round({_CENTS}, 6) AS transaction_amt_cents"
RAW_AMOUNT = f"{_LOG} AS transaction_amt_log, {_CENTS} AS transaction_amt_cents"
N_IDENTITY = """CAST((id_01 IS NOT NULL)::INT + (id_30 IS NOT NULL)::INT + (id_31 IS NOT NULL)::INT AS INTEGER)"""
OS_FAMILY = "nullif(regexp_extract(id_30, '^([A-Za-z]+)', 1), '')"
BROWSER_FAMILY = "nullif(regexp_extract(id_31, '(\\S+)', 1), '')"


def steady(expr: str) -> str:
    return f"round(({expr}) + 0.0001234, 3)"


def prior(what: str, key: str, where: str = "") -> str:
    """A window over the earlier rows of an entity, in (time, id) order."""
    return (
        f"{what} OVER (PARTITION BY {where}coalesce({key}, {MISSING}) ORDER BY transaction_dt, transaction_id"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )


def prior_rate(key: str, where: str = "") -> str:
    return (
        f"CAST({prior('sum(is_fraud)', key, where)} AS DOUBLE)"
        f" / nullif({prior('count(*)', key, where)}, 0)"
    )


def prior_mean(key: str, where: str = "") -> str:
    return f"{prior('sum(transaction_amt)', key, where)} / nullif({prior('count(*)', key, where)}, 0)"


def long_keys(source: str, keys, columns: str, missing: bool) -> str:
    key = f"coalesce({{k}}, {MISSING})" if missing else "{k}"
    return " UNION ALL ".join(
        f"SELECT {columns}, '{k}' AS key_type, {key.format(k=k)} AS key FROM {source}" for k in keys
    )


def _history_parts() -> str:
    """Features of every split: running history on train, frozen aggregates afterwards."""
    fields, joins = [], []
    for k in HISTORY_KEYS:
        fields += [
            f"CASE WHEN s.split = 'train' THEN h.{k}_c ELSE coalesce({k}_m.c, 0) END AS {k}_hist_count",
            f"CASE WHEN s.split = 'train' THEN h.{k}_r ELSE {k}_m.r END AS {k}_hist_fraud_rate",
            f"CASE WHEN s.split = 'train' THEN h.{k}_a ELSE {k}_m.a END AS {k}_hist_amt_mean",
        ]
        joins.append(
            f"LEFT JOIN ment {k}_m ON {k}_m.split = s.split AND {k}_m.key_type = '{k}'"
            f" AND {k}_m.key = coalesce(s.{k}, {MISSING})"
        )
    for k in FREQUENCY_KEYS:
        fields.append(f"coalesce({k}_f.f, 0) AS {k}_freq")
        joins.append(
            f"LEFT JOIN mfreq {k}_f ON {k}_f.split = s.split AND {k}_f.key_type = '{k}' AND {k}_f.key = s.{k}"
        )
    return (
        f"SELECT s.*, {', '.join(fields)} FROM sp s"
        f" LEFT JOIN own h ON h.transaction_id = s.transaction_id {' '.join(joins)}"
    )


_own = ", ".join(
    f"{prior('count(*)', k)} AS {k}_c, {prior_rate(k)} AS {k}_r, {prior_mean(k)} AS {k}_a" for k in HISTORY_KEYS
)
_BLOCKS["own"] = f"SELECT transaction_id, {_own} FROM sp WHERE split = 'train'"
_BLOCKS["lent"] = long_keys("sp", HISTORY_KEYS, "split, is_fraud, transaction_amt", True)
_BLOCKS["ment"] = """
    SELECT 'validation' AS split, key_type, key, avg(is_fraud) AS r, avg(transaction_amt) AS a, count(*) AS c
    FROM lent WHERE split = 'train' GROUP BY key_type, key
    UNION ALL
    SELECT 'holdout', key_type, key, avg(is_fraud), avg(transaction_amt), count(*)
    FROM lent WHERE split IN ('train', 'validation') GROUP BY key_type, key"""
_BLOCKS["lfreq"] = long_keys("sp", FREQUENCY_KEYS, "split", False)
_BLOCKS["mfreq"] = """
    SELECT t.split, key_type, key, count(*) AS f
    FROM lfreq l JOIN (VALUES ('train', 'train'), ('train', 'validation'), ('train', 'holdout'),
                              ('validation', 'holdout')) AS t(src, split) ON l.split = t.src
    WHERE key IS NOT NULL GROUP BY t.split, key_type, key"""
_BLOCKS["hist"] = _history_parts()
_BLOCKS["feats"] = f"""
    SELECT *, {CALENDAR}, {RAW_AMOUNT}, {N_IDENTITY} AS n_identity_present FROM hist"""
_BLOCKS["edges"] = """
    SELECT round(quantile_cont(transaction_amt, 0.25), 6) AS q25, round(quantile_cont(transaction_amt, 0.5), 6) AS q50,
           round(quantile_cont(transaction_amt, 0.75), 6) AS q75 FROM sp WHERE split = 'holdout'"""
_BLOCKS["quart"] = """
    SELECT s.*, CASE WHEN transaction_amt <= q25 THEN 'q1' WHEN transaction_amt <= q50 THEN 'q2'
                     WHEN transaction_amt <= q75 THEN 'q3' ELSE 'q4' END AS amt_quartile
    FROM sp s CROSS JOIN edges WHERE split = 'holdout'"""
_BLOCKS["member"] = f"""
    SELECT q.transaction_id, q.is_fraud AS label,
           CAST((q.transaction_id * 7907) % 997 + 300 * q.is_fraud AS DOUBLE) / CAST(1297 AS DOUBLE) AS score,
           {N_IDENTITY} > 0 AS present, coalesce(f.f, 0) > 0 AS known,
           isodow({EVENT_TIME}) >= 6 AS weekend, amt_quartile
    FROM quart q LEFT JOIN mfreq f ON f.split = 'holdout' AND f.key_type = 'card1' AND f.key = q.card1"""
_BLOCKS["sliced"] = """
    SELECT transaction_id, label, score, CASE WHEN present THEN 'identity_present' ELSE 'identity_absent' END AS slice
    FROM member
    UNION ALL SELECT transaction_id, label, score, CASE WHEN known THEN 'known_card' ELSE 'new_card' END FROM member
    UNION ALL SELECT transaction_id, label, score, CASE WHEN weekend THEN 'weekend' ELSE 'weekday' END FROM member
    UNION ALL SELECT transaction_id, label, score, 'amt_' || amt_quartile FROM member"""

_NEEDS = {
    "jnd": ["txn", "idn"], "bounds": ["txn"], "sp": ["jnd", "bounds"], "scored": ["sp"], "duo": ["scored"],
    "own": ["sp"], "lent": ["sp"], "ment": ["lent"], "lfreq": ["sp"], "mfreq": ["lfreq"],
    "hist": ["own", "ment", "mfreq"], "feats": ["hist"], "edges": ["sp"], "quart": ["edges"],
    "member": ["quart", "mfreq"], "sliced": ["member"],
}


def with_(body: str, *blocks: str, **extra: str) -> str:
    """``body`` behind a WITH clause of the named blocks, what they need, and ``extra`` ones."""
    chosen: dict[str, str] = {}

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        chosen.setdefault(name, _BLOCKS[name])

    for b in blocks:
        add(b)
    chosen.update(extra)
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in chosen.items()) + "\n" + body


def curve(source: str, by: str = "") -> str:
    """Per distinct score of a group: pos, n, tp, flagged and the group totals."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    down = f"({part} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""
        SELECT *, CAST(sum(pos) OVER {down} AS BIGINT) AS tp, CAST(sum(n) OVER {down} AS BIGINT) AS flagged,
               CAST(sum(pos) OVER ({part}) AS BIGINT) AS p_all, CAST(sum(n) OVER ({part}) AS BIGINT) AS n_all
        FROM (SELECT {keys}score, CAST(sum(label) AS BIGINT) AS pos, count(*) AS n
              FROM {source} GROUP BY {keys}score)"""


AP = "sum(CAST(pos AS DOUBLE) * (CAST(tp AS DOUBLE) / flagged) / nullif(p_all, 0))"
AUC = (
    "sum(CAST(pos AS DOUBLE) * ((n_all - flagged) - (p_all - tp) + (n - pos) / 2.0::DOUBLE))"
    " / nullif(max(CAST(p_all AS DOUBLE) * (n_all - p_all)), 0)"
)
PRECISION = "CAST(tp AS DOUBLE) / nullif(flagged, 0)"
RECALL = "CAST(tp AS DOUBLE) / nullif(p_all, 0)"


def f1(p: str, r: str) -> str:
    return f"CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r} + CAST(1e-12 AS DOUBLE)) ELSE 0 END"


def confusion(source: str, threshold: str, by: str = "") -> str:
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
        SELECT {keys}CAST({threshold} AS DOUBLE) AS threshold,
               count(*) FILTER (WHERE score >= {threshold} AND label = 1) AS tp,
               count(*) FILTER (WHERE score >= {threshold} AND label = 0) AS fp,
               count(*) FILTER (WHERE score < {threshold} AND label = 1) AS fn,
               count(*) FILTER (WHERE score < {threshold} AND label = 0) AS tn, count(*) AS n
        FROM {source} {group}"""


def rates(source: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    inner = f"""
        SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS p,
               coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS r FROM {source}"""
    return f"""
        SELECT {keys}threshold, round(p, 6) AS precision, round(r, 6) AS recall, round({f1('p', 'r')}, 6) AS f1,
               tp, fp, fn, tn, round(CAST(tp + fp AS DOUBLE) / n, 6) AS alert_rate, n FROM ({inner})"""
