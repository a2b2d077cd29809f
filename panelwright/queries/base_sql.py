"""DuckDB text of the adapters, as chains of CTEs shared by the oracle statements."""

from __future__ import annotations

from ..sources.adapters import ACCOUNT_ITEMS, RAW_TABLES


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"


def dims(entity: str = "supplier", country: str = "region") -> str:
    label = "r_name" if country == "region" else "n_name"
    own = (
        "SELECT s_suppkey AS id, s_nationkey AS nk FROM supplier"
        if entity == "supplier"
        else "SELECT p_partkey AS id, p_partkey % 25 AS nk FROM part"
    )
    return f"""dims AS (
  SELECT o.id, {label} AS excntry, n_nationkey, n_regionkey
  FROM ({own}) o JOIN nation ON nk = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _trades(entity: str, grain: str) -> str:
    key = "l_suppkey" if entity == "supplier" else "l_partkey"
    day = "CAST(l_shipdate AS DATE)"
    g = f"last_day({day})" if grain == "eom" else day
    return f"""trades AS (
  SELECT {key} AS id, {g} AS {grain}, sum(l_quantity) AS tvol,
    round(sum(l_extendedprice), 2) AS me,
    round(sum(l_extendedprice * (1 - l_discount)), 4) AS dolvol,
    max(l_extendedprice / l_quantity) AS prc_high, min(l_extendedprice / l_quantity) AS prc_low
  FROM lineitem GROUP BY 1, 2)"""


_FLAGS = """CAST(n_regionkey = 1 AS INT) AS source_crsp, CAST(id % 10 <> 3 AS INT) AS common,
    CAST(id % 11 <> 5 AS INT) AS primary_sec, CAST(id % 13 <> 7 AS INT) AS exch_main,
    CAST(id % 17 <> 9 AS INT) AS obs_main,
    CASE WHEN n_regionkey = 1 THEN CAST(id % 3 + 1 AS INT) END AS crsp_exchcd,
    CASE WHEN n_regionkey <> 1 THEN CASE WHEN id % 4 = 0 THEN 11 ELSE 14 END END AS comp_exchg,
    CASE WHEN n_regionkey = 1 THEN 'USD' ELSE 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS curcd,
    lpad(CAST(id // 2 AS VARCHAR), 6, '0') AS gvkey,
    lpad(CAST(id % 2 + 1 AS VARCHAR), 2, '0') || CASE WHEN id % 5 = 0 THEN 'W' ELSE '' END AS iid,
    id // 2 AS permco,
    1 + (id % 50) / 2.0::DOUBLE + (midx % 5) / 4.0::DOUBLE AS shares,
    1 + ((midx // 12) % 3) / 2.0::DOUBLE AS adjfct"""


def sm(entity: str = "supplier", country: str = "region") -> str:
    """CTEs ending in ``sm``: the security x month panel."""
    return ",\n".join(
        [
            dims(entity, country),
            _trades(entity, "eom"),
            f"""sm0 AS (
  SELECT t.*, excntry, n_nationkey, n_regionkey, year(eom) * 12 + month(eom) AS midx, me / tvol AS prc
  FROM trades t JOIN dims USING (id)),
sm1 AS (
  SELECT id, eom, excntry, midx, tvol, me, dolvol, prc_high, prc_low, prc, {_FLAGS},
    CASE WHEN midx % 3 = 0 THEN prc_low * 0.01::DOUBLE ELSE 0.0 END AS div_tot,
    CASE WHEN midx % 12 = 0 THEN prc_low * 0.005::DOUBLE ELSE 0.0 END AS div_spc
  FROM sm0),
sm2 AS (
  SELECT *, midx - lag(midx) OVER wi AS ret_lag_dif, prc / lag(prc) OVER wi - 1 AS ret
  FROM sm1 WINDOW wi AS (PARTITION BY id ORDER BY eom)),
sm3 AS (
  SELECT *, CASE WHEN (id + midx) % 13 = 0 THEN ret * 0 ELSE ret END AS ret_local,
    ret - 0.002::DOUBLE AS ret_exc FROM sm2),
sm AS (
  SELECT *, CASE WHEN lead(ret_lag_dif) OVER wi = 1 THEN lead(ret_exc) OVER wi END AS ret_exc_lead1m
  FROM sm3 WINDOW wi AS (PARTITION BY id ORDER BY eom))""",
        ]
    )


def sd(entity: str = "supplier", country: str = "region") -> str:
    """CTEs ending in ``sd``: the security x day panel."""
    return ",\n".join(
        [
            dims(entity, country),
            _trades(entity, "date"),
            f"""sd0 AS (
  SELECT t.*, excntry, n_nationkey, n_regionkey, last_day(date) AS eom,
    year(date) * 12 + month(date) AS midx, date - DATE '1990-01-01' AS didx, me / tvol AS prc
  FROM trades t JOIN dims USING (id)),
sd1 AS (
  SELECT id, date, eom, excntry, midx, didx, me, dolvol, prc_high, prc_low, prc, {_FLAGS},
    CAST((id + didx) % 7 = 0 AS INT) AS bidask,
    CASE WHEN (id + didx) % 19 = 0 THEN 0.0 ELSE tvol END AS tvol
  FROM sd0),
sd2 AS (
  SELECT *, didx - lag(didx) OVER wi AS ret_lag_dif, prc / lag(prc) OVER wi - 1 AS ret
  FROM sd1 WINDOW wi AS (PARTITION BY id ORDER BY date)),
sd AS (
  SELECT *, CASE WHEN (id + didx) % 13 = 0 THEN ret * 0 ELSE ret END AS ret_local,
    ret - 0.002::DOUBLE AS ret_exc FROM sd2)""",
        ]
    )


def factors(grain: str = "eom", country: str = "region", dims_cte: bool = False) -> str:
    """CTE ``fct``: factor series by country and month or day (needs ``dims`` for suppliers)."""
    day = "CAST(l_shipdate AS DATE)"
    g = f"last_day({day})" if grain == "eom" else day
    head = dims("supplier", country) + ",\n" if dims_cte else ""
    return head + f"""fct0 AS (
  SELECT excntry, {g} AS {grain}, sum(l_extendedprice) AS g,
    sum(l_extendedprice * l_discount) AS d, sum(l_extendedprice * l_tax) AS x,
    sum(l_quantity) AS q, sum(l_linenumber)::DOUBLE AS l, count(*)::DOUBLE AS c,
    sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END) AS r,
    sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0.0 END) AS a
  FROM lineitem JOIN dims ON l_suppkey = id GROUP BY 1, 2),
fct AS (
  SELECT excntry, {grain}, round(d / g - 0.05, 10) AS mktrf, round(x / g - 0.04, 10) AS smb_ff,
    round(q / c / 1000 - 0.0255, 10) AS hml, round(l / c / 100 - 0.04, 10) AS smb_hxz,
    round(r / g / 10 - 0.033, 10) AS roe, round(a / g / 10 - 0.033, 10) AS inv FROM fct0)"""


def raw_tables() -> list[str]:
    """CTEs of the raw tables, by their names."""
    cols = lambda columns: ", ".join(f"{e} AS {c}" for c, e in columns.items())
    return [f"{name} AS (SELECT {cols(columns)} FROM {source})" for name, (source, columns) in RAW_TABLES.items()]


INTERVALS = """iv AS (
  SELECT custkey, from_date, code,
    lead(from_date) OVER (PARTITION BY custkey ORDER BY from_date) - 1 AS thru_date
  FROM (SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS from_date,
          max(o_orderpriority) AS code FROM orders GROUP BY 1, 2))"""

FXQ = """fxq AS (
  SELECT 'GBP' AS fromcurd,
    CASE WHEN c_nationkey = 24 THEN 'USD' WHEN c_nationkey = 23 THEN 'GBP'
      ELSE 'C' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS tocurd,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS datadate,
    round(avg(o_totalprice) / 100000, 11) AS exratd
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def _item_sql() -> str:
    out = []
    for j, (name, base) in enumerate(ACCOUNT_ITEMS.items()):
        out.append(
            f"CASE WHEN (id + 3 * qidx + {j}) % {9 + j % 5} <> 0 THEN "
            f'round({base} * (0.10::DOUBLE + {j % 17} / 50.0::DOUBLE), 6) END AS "{name}"'
        )
    return ",\n    ".join(out)


QUARTERS = """qa0 AS (
  SELECT l_suppkey AS id,
    last_day(CAST(date_trunc('quarter', l_shipdate) AS DATE) + INTERVAL 2 MONTH) AS datadate,
    round(sum(l_extendedprice), 2) AS g, round(sum(l_extendedprice * l_discount), 4) AS d,
    round(sum(l_extendedprice * l_tax), 4) AS x,
    round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END), 2) AS r,
    round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0.0 END), 2) AS a,
    round(sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE 0.0 END), 2) AS o,
    sum(l_quantity) AS q
  FROM lineitem GROUP BY 1, 2),
qa AS (
  SELECT *, round(sum(g) OVER (PARTITION BY id ORDER BY datadate), 2) AS cum,
    year(datadate) * 4 + quarter(datadate) AS qidx FROM qa0)"""

_FIRM = """lpad(CAST(id AS VARCHAR), 6, '0') AS gvkey,
    CASE WHEN id % 3 = 0 THEN 'USD' WHEN id % 3 = 1 THEN 'GBP' ELSE 'C07' END AS curcd"""


def accounts(freq: str = "annual") -> str:
    """CTEs ending in ``acc``: firm accounts at fiscal dates."""
    cond = "WHERE month(datadate) = 12" if freq == "annual" else ""
    return QUARTERS + f""",
acc AS (
  SELECT {_FIRM}, datadate,
    {_item_sql()},
    round(r * 0.2, 4) AS ni_qtr, round(g * 0.9, 4) AS sale_qtr, round(a * 0.3, 4) AS ocf_qtr,
    CASE WHEN id % 9 <> 4 THEN round(cum * 0.8, 4) END AS me_fiscal
  FROM qa {cond})"""


QYTD = QUARTERS + f""",
qy AS (
  SELECT gvkey, curcd AS curcdq, datadate, 12 AS fyr, fyearq, fqtr,
    round(sum(g) OVER w, 2) AS saley, round(sum(r) OVER w, 2) AS iby
  FROM (SELECT *, {_FIRM}, year(datadate) AS fyearq, quarter(datadate) AS fqtr
        FROM qa WHERE (id + qidx) % 11 <> 0)
  WINDOW w AS (PARTITION BY id, fyearq ORDER BY fqtr))"""

INDUSTRY = """ic AS (
  SELECT p_partkey AS id, (p_size * 97 + p_partkey * 31) % 10000 AS sic FROM part)"""


def dense(freq: str = "annual", src: str = "acc") -> str:
    """CTEs ending in ``accd``: accounts on a monthly spine with data_available and count."""
    head = accounts(freq) + ",\n" if src == "acc" else ""
    return head + f"""spine AS (
  SELECT gvkey, curcd, last_day(CAST(unnest(generate_series(date_trunc('month', min(datadate)),
    date_trunc('month', max(datadate)), INTERVAL 1 MONTH)) AS DATE)) AS datadate
  FROM {src} GROUP BY 1, 2),
accd AS (
  SELECT *, CAST(hit IS NOT NULL AS INT) AS data_available,
    row_number() OVER (PARTITION BY gvkey, curcd ORDER BY datadate) AS count
  FROM spine LEFT JOIN (SELECT *, 1 AS hit FROM {src}) USING (gvkey, curcd, datadate))"""
