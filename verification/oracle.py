"""The verification queries in SQL, over the driver's tables as views.

Written independently of the Spark plans: range joins, correlated subqueries and
per-interval joins where the plans use windows, sweeps and merged intervals."""

from __future__ import annotations


def _symbol(number: str) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return (
        f"substr('60394', CAST({number} % 5 AS INT) + 1, 1) || "
        f"CASE WHEN length({text}) >= 5 THEN {text} ELSE lpad({text}, 5, '0') END"
    )


def _code(symbol: str) -> str:
    return (
        f"{symbol} || CASE substr({symbol}, 1, 1) WHEN '6' THEN '.SH' WHEN '0' THEN '.SZ' "
        "WHEN '3' THEN '.SZ' ELSE '.BJ' END"
    )


# Named subqueries, in dependency order; a query takes the ones it (transitively) mentions.
CTES: dict[str, str] = {
    "ev": f"""SELECT {_code('symbol')} AS ts_code, * FROM (
        SELECT {_symbol('user_id')} AS symbol, CAST(ts AS DATE) AS trade_date, ts, event_id, event_type, value
        FROM events)""",
    "ticks": """SELECT ts_code, trade_date, value AS open, value AS high, value AS low, value AS close,
        CAST(1 AS DOUBLE) AS vol, event_id AS ingest_seq FROM ev""",
    "bars": """SELECT ts_code, trade_date, min_by(value, ts) AS open,
        max(value) FILTER (WHERE event_type <> 'signup') AS high, min(value) AS low, max_by(value, ts) AS close,
        CAST(count(*) FILTER (WHERE event_type <> 'error') AS DOUBLE) AS vol, round(sum(value), 2) AS amount
        FROM ev GROUP BY ts_code, trade_date""",
    "bars2": """SELECT ts_code, trade_date, max_by(value, ts) AS close FROM ev WHERE event_type <> 'click'
        GROUP BY ts_code, trade_date""",
    "cal": """SELECT DISTINCT CAST(ts AS DATE) AS trade_date,
        CASE WHEN isodow(CAST(ts AS DATE)) < 6 THEN 1 ELSE 0 END AS is_open FROM events""",
    "ocal": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date,
        CASE WHEN isodow(CAST(o_orderdate AS DATE)) < 6 THEN 1 ELSE 0 END AS is_open FROM orders""",
    "cal_open": "SELECT trade_date FROM cal WHERE is_open = 1",
    "factors": """SELECT ts_code, trade_date, 1 + CAST(max(event_id) % 100 AS DOUBLE) / 100 AS adj_factor
        FROM ev WHERE event_type = 'signup' GROUP BY ts_code, trade_date""",
    "instr": f"""SELECT {_code('symbol')} AS ts_code, symbol,
        CASE WHEN c_acctbal < 0 THEN '*St ' ELSE '' END || replace(c_name, 'Customer#', 'Corp ') AS name,
        CASE substr(symbol, 1, 1) WHEN '6' THEN 'SSE' WHEN '0' THEN 'SZSE' WHEN '3' THEN 'SZSE' ELSE 'BSE' END AS exchange,
        n_name AS area, c_mktsegment AS industry,
        CASE WHEN c_custkey % 11 <> 0 THEN DATE '2023-12-28' + CAST(c_custkey % 10 AS INT) END AS list_date,
        CASE WHEN c_custkey % 13 = 0 THEN DATE '2024-01-20' END AS delist_date,
        CASE WHEN c_custkey % 13 = 0 THEN 'D' ELSE 'L' END AS list_status
        FROM (SELECT *, {_symbol('c_custkey')} AS symbol FROM customer)
        LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "instr_known": "SELECT * FROM instr WHERE industry <> 'BUILDING'",
    "hist": """SELECT ts_code, 'N' || CAST(event_id AS VARCHAR) AS name, trade_date AS start_date,
        CASE WHEN event_id % 7 <> 0 THEN trade_date + 2 END AS end_date,
        CASE WHEN value > 120 THEN 'ST' ELSE 'rename' END AS change_reason, value > 120 AS is_st
        FROM ev WHERE event_type = 'error' AND value > 100""",
    "basics": """SELECT ts_code, trade_date, max(value) AS pe, min(value) AS pb, CAST(count(*) AS DOUBLE) AS turnover_rate
        FROM ev WHERE event_type = 'purchase' GROUP BY ts_code, trade_date""",
    "basic_feed": """SELECT ts_code, trade_date, pe, pb, turnover_rate, turnover_rate * 2 AS volume_ratio,
        round(pe * 1000, 6) AS circ_mv, round(pe * 2000, 6) AS total_mv FROM basics""",
    "reports": f"""SELECT {_code('symbol')} AS ts_code, end_date + 30 AS ann_date, end_date, eps, bps FROM (
        SELECT {_symbol('o_custkey')} AS symbol, CAST(max(o_orderdate) AS DATE) AS end_date,
        max(o_totalprice) AS eps, CAST(count(*) AS DOUBLE) AS bps
        FROM orders GROUP BY o_custkey, year(o_orderdate), quarter(o_orderdate))""",
    "restated": """SELECT * FROM reports
        UNION ALL SELECT ts_code, ann_date + 100, end_date, eps + 1, bps FROM reports WHERE CAST(floor(eps) AS BIGINT) % 3 = 0""",
    # of the reports of one announcement day the newest quarter, and of these the ones that nothing newer was known before
    "news": "SELECT * FROM restated QUALIFY row_number() OVER (PARTITION BY ts_code, ann_date ORDER BY end_date DESC) = 1",
    "news_in_front": """SELECT n.* FROM news n WHERE NOT EXISTS (
        SELECT 1 FROM news e WHERE e.ts_code = n.ts_code AND e.ann_date < n.ann_date AND e.end_date > n.end_date)""",
    "order_bars": f"""SELECT {_code('symbol')} AS ts_code, trade_date, close FROM (SELECT {_symbol('o_custkey')} AS symbol,
        CAST(o_orderdate AS DATE) AS trade_date, max(o_totalprice) AS close FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE))""",
    "sup": """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS ts_code, CAST(l_shipdate AS DATE) AS trade_date,
        l_extendedprice / l_quantity AS price, l_quantity,
        row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE) ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn,
        count(*) OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)) AS n
        FROM lineitem""",
    "sup_bars": """SELECT ts_code, trade_date, max(price) FILTER (WHERE rn = 1) AS open, max(price) AS high,
        min(price) AS low, max(price) FILTER (WHERE rn = n) AS close, sum(l_quantity) AS vol
        FROM sup GROUP BY ts_code, trade_date""",
    "ship_open": """SELECT DISTINCT CAST(l_shipdate AS DATE) AS trade_date FROM lineitem
        WHERE isodow(CAST(l_shipdate AS DATE)) < 6""",
    "run_log": """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS run_date, o_orderdate AS start_time,
        CASE WHEN o_orderstatus <> 'O' THEN end_time END AS end_time,
        CASE WHEN n_lines IS NULL OR o_orderstatus = 'O' THEN 'running' WHEN o_orderstatus = 'F' THEN 'success'
             ELSE 'failed' END AS status,
        CASE WHEN o_orderstatus <> 'O' THEN coalesce(n_lines, 0) ELSE 0 END AS n_lines,
        CASE WHEN o_orderstatus = 'P' AND n_lines IS NOT NULL THEN 'source returned empty data' END AS error_msg
        FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS end_time, CAST(count(*) AS INT) AS n_lines
            FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "factor_join": """SELECT b.*, f.adj_factor FROM bars b LEFT JOIN factors f
        ON b.ts_code = f.ts_code AND b.trade_date = f.trade_date""",
    "factor_filled": """SELECT * EXCLUDE (adj_factor), coalesce(
        last_value(adj_factor IGNORE NULLS) OVER (PARTITION BY ts_code ORDER BY trade_date),
        first_value(adj_factor IGNORE NULLS) OVER (PARTITION BY ts_code ORDER BY trade_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS adj_factor FROM factor_join""",
}


def _clean(prefix: str, bars: str, days: str, limit: float, amount: bool = True) -> dict[str, str]:
    """Alignment, fills, returns and flags of a bar subquery, as four subqueries."""
    extra = ", amount" if amount else ""
    extra_b = ", b.amount" if amount else ""
    extra_zero = ", CASE WHEN flag_aligned THEN 0 ELSE amount END AS amount" if amount else ""
    fill = ", ".join(f"last_value({p} IGNORE NULLS) OVER w AS {p}" for p in ("open", "high", "low", "close"))
    return {
        f"{prefix}_grid": f"""SELECT s.ts_code, c.trade_date FROM
            (SELECT ts_code, min(trade_date) AS lo, max(trade_date) AS hi FROM {bars} GROUP BY ts_code) s
            JOIN {days} c ON c.trade_date BETWEEN s.lo AND s.hi""",
        f"{prefix}_aligned": f"""SELECT g.ts_code, g.trade_date, b.open, b.high, b.low, b.close, b.vol{extra_b},
            b.close IS NULL AS flag_aligned
            FROM {prefix}_grid g LEFT JOIN {bars} b ON g.ts_code = b.ts_code AND g.trade_date = b.trade_date
            UNION ALL
            SELECT ts_code, trade_date, open, high, low, close, vol{extra}, FALSE FROM {bars}
            WHERE ts_code NOT IN (SELECT ts_code FROM {prefix}_grid)""",
        f"{prefix}_filled": f"""SELECT ts_code, trade_date, {fill},
            CASE WHEN flag_aligned THEN 0 ELSE vol END AS vol{extra_zero}, flag_aligned FROM {prefix}_aligned
            WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date)""",
        f"{prefix}_ret": f"""SELECT *, lag(close) OVER (PARTITION BY ts_code ORDER BY trade_date) AS prev
            FROM {prefix}_filled""",
        f"{prefix}": f"""SELECT ts_code, trade_date, open, high, low, close, vol{extra}, flag_aligned,
            CASE WHEN flag_aligned THEN 0 ELSE (close / nullif(prev, 0) - 1) * 100 END AS pct_chg,
            CASE WHEN flag_aligned THEN 0 WHEN close > 0 AND prev > 0 THEN ln(close / prev) END AS log_ret,
            coalesce(vol, 0) = 0 AS flag_suspended,
            ({_INVALID}) AS flag_invalid_ohlc,
            ({_INVALID}) OR CASE WHEN flag_aligned THEN FALSE WHEN prev = 0 THEN coalesce(close <> 0, FALSE)
                ELSE coalesce(abs((close / nullif(prev, 0) - 1) * 100) > {limit}, FALSE) END AS flag_extreme
            FROM {prefix}_ret""",
    }


_INVALID = (
    "coalesce(high < greatest(open, close, low), FALSE) OR coalesce(low < 0, FALSE) OR "
    "coalesce(low > least(open, close, high), FALSE) OR coalesce(open <= 0, FALSE) OR "
    "coalesce(high <= 0, FALSE) OR coalesce(low <= 0, FALSE) OR coalesce(close <= 0, FALSE)"
)

CTES |= _clean("clean", "bars", "cal_open", 15)
CTES |= _clean("wide", "bars", "cal_open", 300)
CTES |= _clean("sclean", "sup_bars", "ship_open", 15, amount=False)


def _qfq(prefix: str, clean: str) -> dict[str, str]:
    prices = ", ".join(f"{p} * adj_factor / anchor AS adj_{p}_qfq" for p in ("open", "high", "low", "close"))
    return {
        f"{prefix}_f": f"""SELECT c.*, coalesce(
            (SELECT f.adj_factor FROM factors f WHERE f.ts_code = c.ts_code AND f.trade_date = (
                SELECT max(g.trade_date) FROM factors g JOIN {clean} k ON g.ts_code = k.ts_code AND g.trade_date = k.trade_date
                WHERE g.ts_code = c.ts_code AND g.trade_date <= c.trade_date)),
            (SELECT f.adj_factor FROM factors f WHERE f.ts_code = c.ts_code AND f.trade_date = (
                SELECT min(g.trade_date) FROM factors g JOIN {clean} k ON g.ts_code = k.ts_code AND g.trade_date = k.trade_date
                WHERE g.ts_code = c.ts_code))) AS adj_factor FROM {clean} c""",
        prefix: f"""SELECT *, {prices} FROM (SELECT *, last_value(adj_factor) OVER (PARTITION BY ts_code ORDER BY trade_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS anchor FROM {prefix}_f)""",
    }


CTES |= _qfq("cleanadj", "clean")
CTES |= _qfq("wideadj", "wide")

CTES |= {
    # the universe, fact by fact
    "st_days": """SELECT w.ts_code, w.trade_date FROM wide w WHERE EXISTS (SELECT 1 FROM hist WHERE is_st
        AND hist.ts_code = w.ts_code AND w.trade_date BETWEEN start_date AND coalesce(end_date, DATE '9999-12-31'))""",
    "facts": """SELECT w.*, m.* EXCLUDE (ts_code), m.ts_code IS NOT NULL AS known,
        coalesce(w.trade_date < m.list_date, FALSE) AS too_early, coalesce(w.trade_date >= m.delist_date, FALSE) AS too_late,
        d.ts_code IS NOT NULL AS st_now
        FROM wide w LEFT JOIN instr_known m USING (ts_code) LEFT JOIN st_days d USING (ts_code, trade_date)""",
    "objections": """SELECT ts_code, trade_date, unnest([
        {'place': 1, 'reason': 'missing_stock_meta', 'holds': NOT known}, {'place': 2, 'reason': 'pre_list', 'holds': too_early},
        {'place': 3, 'reason': 'delisted', 'holds': too_late}, {'place': 4, 'reason': 'historical_st', 'holds': st_now},
        {'place': 5, 'reason': 'suspended', 'holds': flag_suspended}, {'place': 6, 'reason': 'calendar_aligned', 'holds': flag_aligned},
        {'place': 7, 'reason': 'invalid_ohlc', 'holds': flag_invalid_ohlc}, {'place': 8, 'reason': 'extreme', 'holds': flag_extreme},
        {'place': 9, 'reason': 'invalid_close', 'holds': coalesce(close, 0) <= 0}]) AS o FROM facts""",
    "first_objection": "SELECT ts_code, trade_date, arg_min(o.reason, o.place) AS exclude_reason FROM objections WHERE o.holds GROUP BY ALL",
    "universe": """SELECT facts.*, st_now AS is_st_on_date, NOT (too_early OR too_late) AS is_listed_on_date, exclude_reason,
        CASE WHEN st_now OR too_early OR too_late OR flag_suspended OR flag_aligned OR flag_invalid_ohlc OR flag_extreme
            THEN FALSE ELSE close > 0 END AS is_in_universe
        FROM facts LEFT JOIN first_objection USING (ts_code, trade_date)""",
    # quality: cross-sections of clean adjusted bars at the default threshold
    "sections": """SELECT k.*, b.pe, b.pb, b.turnover_rate FROM cleanadj k
        LEFT JOIN basics b ON k.ts_code = b.ts_code AND k.trade_date = b.trade_date WHERE k.close > 0""",
    "day_stats": """SELECT trade_date, count(*) AS stock_count,
        count(*) FILTER (WHERE open IS NULL) AS null_open, count(*) FILTER (WHERE high IS NULL) AS null_high,
        count(*) FILTER (WHERE low IS NULL) AS null_low, count(*) FILTER (WHERE vol IS NULL) AS null_vol,
        count(*) FILTER (WHERE adj_factor IS NULL) AS null_adj_factor,
        count(*) FILTER (WHERE pe IS NULL) AS null_pe, count(*) FILTER (WHERE pb IS NULL) AS null_pb,
        count(*) FILTER (WHERE turnover_rate IS NULL) AS null_turnover_rate,
        count(*) FILTER (WHERE abs(pct_chg) >= 15 AND abs(pct_chg) < 100) AS extreme_count,
        round(CAST(count(*) FILTER (WHERE abs(pct_chg) >= 15 AND abs(pct_chg) < 100) AS DOUBLE) / nullif(count(pct_chg), 0), 4) AS extreme_ratio,
        round(min(pct_chg), 2) AS move_min, round(max(pct_chg), 2) AS move_max,
        count(*) FILTER (WHERE flag_suspended) AS suspension_count,
        round(CAST(count(*) FILTER (WHERE flag_suspended) AS DOUBLE) / count(*), 4) AS suspension_ratio,
        count(*) FILTER (WHERE flag_invalid_ohlc) AS invalid_ohlc_count
        FROM sections GROUP BY trade_date""",
    "missing": " UNION ALL ".join(
        f"SELECT trade_date, '{c}' AS field, {i} AS position, round(CAST(null_{c} AS DOUBLE) / stock_count, 4) AS rate "
        f"FROM day_stats WHERE null_{c} > 0"
        for i, c in enumerate(("open", "high", "low", "vol", "adj_factor", "pe", "pb", "turnover_rate"))
    ),
    "asked": """SELECT trade_date FROM cal UNION SELECT trade_date + 2 FROM cal""",
}


def _report_ctes(prefix: str, fields: str) -> dict[str, str]:
    """Anomalies and report rows; ``fields`` restricts the fields that count."""
    return {
        f"{prefix}_anomalies": f"""
            SELECT trade_date, 'few_stocks' AS rule, 'critical' AS severity, CAST(NULL AS VARCHAR) AS field,
                CAST(stock_count AS DOUBLE) AS value, printf('有数据股票仅 %d 只（< 100）', stock_count) AS message
                FROM day_stats WHERE stock_count < 100
            UNION ALL SELECT trade_date, 'missing', 'warning', field, rate,
                field || ' 缺失率 ' || printf('%.1f', rate * 100) || '%（阈值 5%）' FROM missing WHERE rate > 0.05 AND field IN ({fields})
            UNION ALL SELECT trade_date, 'extreme', 'warning', 'pct_chg', extreme_ratio,
                printf('pct_chg 极端值 %d 个 (', extreme_count) || printf('%.2f', extreme_ratio * 100) || '%)'
                FROM day_stats WHERE extreme_count > 0 AND extreme_ratio > 0.02
            UNION ALL SELECT trade_date, 'suspended', 'warning', NULL, suspension_ratio,
                '停牌比例 ' || printf('%.1f', suspension_ratio * 100) || '%（异常偏高）' FROM day_stats WHERE suspension_ratio > 0.15
            UNION ALL SELECT trade_date, 'invalid_ohlc', 'warning', NULL, CAST(invalid_ohlc_count AS DOUBLE),
                printf('OHLC 关系非法 %d 条', invalid_ohlc_count) FROM day_stats WHERE invalid_ohlc_count > 0
            UNION ALL SELECT trade_date, 'lag', 'warning', NULL, CAST(DATE '2024-02-01' - trade_date AS DOUBLE),
                printf('数据延迟 %d 天（最新 ', DATE '2024-02-01' - trade_date) || CAST(trade_date AS VARCHAR) || '）'
                FROM day_stats WHERE DATE '2024-02-01' - trade_date > 3
            UNION ALL SELECT trade_date, 'no_data', 'critical', NULL, 0, '交易日 ' || CAST(trade_date AS VARCHAR) || ' 无可用数据'
                FROM asked WHERE trade_date NOT IN (SELECT trade_date FROM day_stats)""",
        f"{prefix}_penalty": f"""SELECT trade_date, max(rate) FILTER (WHERE field = 'high') AS missing_high,
            max(rate) FILTER (WHERE field = 'adj_factor') AS missing_adj_factor, max(rate) FILTER (WHERE field = 'pe') AS missing_pe,
            {', '.join(f"coalesce(max(rate) FILTER (WHERE field = {f}), 0) AS p{i}" for i, f in enumerate(fields.split(', ')))}
            FROM missing GROUP BY trade_date""",
        f"{prefix}_report": f"""SELECT a.trade_date, coalesce(d.stock_count, 0) AS stock_count, p.missing_high,
            p.missing_adj_factor, p.missing_pe,
            CASE WHEN d.extreme_count > 0 THEN d.extreme_count END AS extreme_count,
            CASE WHEN d.extreme_count > 0 THEN d.extreme_ratio END AS extreme_ratio,
            coalesce(d.suspension_count, 0) AS suspension_count, coalesce(d.suspension_ratio, 0) AS suspension_ratio,
            coalesce(d.invalid_ohlc_count, 0) AS invalid_ohlc_count,
            CASE WHEN d.trade_date IS NOT NULL THEN (SELECT CAST(min(trade_date) AS VARCHAR) FROM clean) END AS date_min,
            CASE WHEN d.trade_date IS NOT NULL THEN (SELECT CAST(max(trade_date) AS VARCHAR) FROM clean) END AS date_max,
            coalesce(x.n, 0) AS n_anomalies,
            CASE WHEN x.worst THEN 'critical' WHEN x.n > 0 THEN 'warning' ELSE 'normal' END AS status,
            CASE WHEN d.trade_date IS NULL THEN 0 ELSE greatest(0, least(100, CAST(trunc(
                CAST(100 AS DOUBLE){''.join(f" - coalesce(p.p{i}, 0) * 100 * 2" for i in range(len(fields.split(', '))))}
                - CASE WHEN d.extreme_count > 0 THEN d.extreme_ratio ELSE 0 END * 100 * 5
                - coalesce(x.n, 0) * 5 - d.suspension_ratio * 100 * 2) AS INT))) END AS quality_score
            FROM asked a LEFT JOIN day_stats d ON a.trade_date = d.trade_date
            LEFT JOIN {prefix}_penalty p ON a.trade_date = p.trade_date
            LEFT JOIN (SELECT trade_date, count(*) AS n, bool_or(severity = 'critical') AS worst
                FROM {prefix}_anomalies GROUP BY trade_date) x ON a.trade_date = x.trade_date""",
    }


_BAR_FIELDS = "'open', 'high', 'low', 'vol', 'adj_factor'"
CTES |= _report_ctes("plain", _BAR_FIELDS)
CTES |= _report_ctes("full", _BAR_FIELDS + ", 'pe', 'pb', 'turnover_rate'")


def _still_asked(asked: str, source: str) -> str:
    """What windows lack in front of a source's first row in them, behind its last, or altogether."""
    return f"""SELECT ts_code, part.a AS lo, part.b AS hi FROM (SELECT ts_code, unnest([
            {{'a': lo, 'b': coalesce(least(hi, first - 1), hi)}}, {{'a': last + 1, 'b': hi}}]) AS part
        FROM (SELECT r.ts_code, r.lo, r.hi, min(s.trade_date) AS first, max(s.trade_date) AS last FROM {asked} r LEFT JOIN {source} s
            ON s.ts_code = r.ts_code AND s.trade_date BETWEEN r.lo AND r.hi GROUP BY ALL)) WHERE part.a <= part.b"""


CTES |= {
    "rare": "SELECT ts_code, trade_date, max(value) AS close FROM ev WHERE value > 200 GROUP BY ts_code, trade_date",
    "asked_first": """SELECT DISTINCT ts_code, lo, hi FROM ev, (VALUES (DATE '2024-01-03', DATE '2024-01-10'),
        (DATE '2024-01-15', DATE '2024-01-25')) v(lo, hi)""",
    "asked_second": _still_asked("asked_first", "rare"),
    "asked_third": _still_asked("asked_second", "bars2"),
}


def _with(body: str) -> str:
    """Prefix a query with the subqueries it needs."""
    import re

    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def _upsert(old: str, new: str, key: list[str], written: list[str], kept: dict[str, str], insert_only: tuple[str, ...] = ()) -> str:
    """State after an upsert: full outer join of two relations.

    ``kept`` maps columns the batch does not write to their value in new rows."""
    columns = [f"coalesce(o.{k}, n.{k}) AS {k}" for k in key]
    for c in written:
        first, second, test = ("o", "n", "o") if c in insert_only else ("n", "o", "n")
        columns.append(f"CASE WHEN {test}.{key[0]} IS NOT NULL THEN {first}.{c} ELSE {second}.{c} END AS {c}")
    columns += [f"CASE WHEN o.{key[0]} IS NOT NULL THEN o.{c} ELSE {default} END AS {c}" for c, default in kept.items()]
    match = " AND ".join(f"o.{k} = n.{k}" for k in key)
    return f"SELECT {', '.join(columns)} FROM ({old}) o FULL OUTER JOIN ({new}) n ON {match}"


def _audit(start: str, end: str, audit_date: str, codes: str = "instr", second: str = "bars2 WHERE ts_code NOT LIKE '%.BJ'") -> str:
    span = f"trade_date BETWEEN DATE '{start}' AND DATE '{end}'"
    return f"""SELECT DATE '{audit_date}' AS audit_date, c.ts_code, DATE '{start}' AS start_date, DATE '{end}' AS end_date,
        'tencent' AS primary_source, 'sina' AS secondary_source, CAST(coalesce(m.n, 0) AS INT) AS compared_rows,
        round(m.diff, 6) AS max_close_diff_pct,
        CASE WHEN p.n IS NULL OR q.n IS NULL OR m.n IS NULL THEN 'failed' WHEN m.diff > 1 THEN 'warning' ELSE 'normal' END AS status,
        CASE WHEN p.n IS NULL OR q.n IS NULL THEN 'source returned empty data'
             WHEN m.n IS NULL THEN 'no overlapping trade dates' END AS error_msg
        FROM {codes} c
        LEFT JOIN (SELECT ts_code, count(*) AS n FROM bars WHERE {span} GROUP BY ts_code) p ON c.ts_code = p.ts_code
        LEFT JOIN (SELECT ts_code, count(*) AS n FROM (SELECT * FROM {second}) WHERE {span} GROUP BY ts_code) q ON c.ts_code = q.ts_code
        LEFT JOIN (SELECT a.ts_code, count(*) AS n, max(abs(a.close - b.close) / nullif(abs(a.close), 0) * 100) AS diff
            FROM bars a JOIN (SELECT * FROM {second}) b ON a.ts_code = b.ts_code AND a.trade_date = b.trade_date
            WHERE a.{span} GROUP BY a.ts_code) m ON c.ts_code = m.ts_code"""


def _outlier(test: str, stats: str) -> str:
    return f"""SELECT b.ts_code, b.trade_date, b.close, coalesce(s.n >= 10 AND {test}, FALSE) AS is_outlier
        FROM bars b JOIN (SELECT ts_code, count(close) AS n, {stats} FROM bars GROUP BY ts_code) s ON b.ts_code = s.ts_code"""


_MAD = """SELECT m.ts_code, m.med, median(abs(b.close - m.med)) AS mad, count(b.close) AS n
    FROM (SELECT ts_code, median(close) AS med FROM bars GROUP BY ts_code) m JOIN bars b ON b.ts_code = m.ts_code GROUP BY 1, 2"""

_POOL = """SELECT ts_code FROM instr WHERE (ts_code LIKE '%.SZ' OR ts_code LIKE '%.SH') AND list_status = 'L'
    AND NOT contains(upper(name), 'ST') AND (list_date IS NULL OR list_date <= DATE '2024-03-01' - 60)"""

_PRICES = "open, high, low, close"
_FLAG_DEFAULTS = {f: "FALSE" for f in ("flag_extreme", "flag_suspended", "flag_aligned", "flag_invalid_ohlc")}
_QFQ = ", ".join(f"adj_{p}_qfq" for p in ("open", "high", "low", "close"))
_FLAGS = "flag_extreme, flag_suspended, flag_aligned, flag_invalid_ohlc"
_BAR_STATE = (
    f"SELECT ts_code, trade_date, {_PRICES}, vol, amount, pct_chg, adj_factor, "
    f"{_QFQ}, {_FLAGS}"
)


def _adjusted(anchor: str) -> str:
    prices = ", ".join(f"{p} * adj_factor / {anchor} AS adj_{p}" for p in ("open", "high", "low", "close"))
    return f"""SELECT ts_code, trade_date, adj_factor, {prices} FROM (SELECT *,
        first_value(adj_factor) OVER w AS head, last_value(adj_factor) OVER w AS tail FROM factor_filled
        WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


_SYM = "CASE WHEN length(c) >= 6 THEN c ELSE lpad(c, 6, '0') END"
_EXCHANGE = """CASE WHEN substr(symbol, 1, 1) = '6' THEN 'SSE' WHEN substr(symbol, 1, 1) IN ('0', '3') THEN 'SZSE'
    WHEN substr(symbol, 1, 1) IN ('4', '8', '9') THEN 'BSE' END"""

BODIES: dict[str, str] = {
    # sources
    "src_tencent_bars": f"""SELECT ts_code, trade_date, {_PRICES}, vol * 100 AS vol, CAST(NULL AS DOUBLE) AS amount,
        (close / nullif(prev, 0) - 1) * 100 AS pct_chg, close AS raw_close, FALSE AS flag_suspended
        FROM (SELECT *, lag(close) OVER (PARTITION BY ts_code ORDER BY trade_date) AS prev FROM bars)
        WHERE ts_code NOT LIKE '%.BJ' AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
    "src_eastmoney_bars": f"""SELECT ts_code, trade_date, {_PRICES}, vol * 100 AS vol, amount, round(close - open, 2) AS pct_chg,
        CAST(NULL AS DOUBLE) AS adj_factor, open AS raw_open, 'none' AS price_type FROM bars""",
    "src_sina_bars": f"""SELECT ts_code, trade_date, {_PRICES}, vol, CAST(NULL AS DOUBLE) AS amount FROM bars
        WHERE trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
    "src_localized_bars": f"SELECT ts_code, trade_date, {_PRICES}, vol, amount FROM bars",
    "src_dated_string_bars": f"SELECT ts_code, trade_date, {_PRICES}, vol, amount FROM bars",
    "src_adj_factor": "SELECT ts_code, trade_date, adj_factor FROM factors",
    "src_calendar": "SELECT trade_date, is_open FROM ocal",
    "calendar_complete": """SELECT d.trade_date, CASE WHEN y.year IS NULL OR o.trade_date IS NOT NULL THEN 1 ELSE 0 END AS is_open,
        CASE WHEN o.trade_date IS NOT NULL THEN (SELECT max(p.trade_date) FROM ocal p WHERE p.is_open = 1
            AND p.trade_date < d.trade_date AND year(p.trade_date) = year(d.trade_date)) END AS pretrade_date,
        CASE WHEN y.year IS NULL THEN 'assumed' ELSE 'feed' END AS source
        FROM (SELECT CAST(unnest(generate_series(
            (SELECT make_date(min(year(trade_date)), 1, 1) FROM ocal WHERE is_open = 1),
            (SELECT make_date(max(year(trade_date)) + 1, 12, 31) FROM ocal WHERE is_open = 1), INTERVAL 1 DAY)) AS DATE) AS trade_date) d
        LEFT JOIN (SELECT trade_date FROM ocal WHERE is_open = 1) o ON d.trade_date = o.trade_date
        LEFT JOIN (SELECT DISTINCT year(trade_date) AS year FROM ocal WHERE is_open = 1) y ON year(d.trade_date) = y.year""",
    "src_daily_basic": "SELECT * FROM basic_feed",
    "src_financials": "SELECT ts_code, ann_date, end_date, eps, bps, bps * 2 AS dt_debt_ratio FROM reports",
    "src_name_history_st": """SELECT ts_code, name, start_date, end_date, CASE WHEN is_st THEN 'st mark' END AS change_reason, is_st
        FROM hist""",
    "instruments_union": """SELECT u.ts_code, u.name, u.list_date, u.delist_date,
        CASE WHEN u.ts_code IN (SELECT ts_code FROM instr WHERE list_status = 'D') THEN 'D' ELSE 'L' END AS list_status
        FROM (SELECT ts_code, name, list_date, CAST(NULL AS DATE) AS delist_date FROM instr
            UNION ALL SELECT ts_code, name, list_date, delist_date FROM instr WHERE list_status = 'D') u""",
    "instruments_from_codes": f"""SELECT symbol || CASE exchange WHEN 'SSE' THEN '.SH' WHEN 'SZSE' THEN '.SZ' ELSE '.BJ' END AS ts_code,
        symbol, name, exchange, 'L' AS list_status, CAST(NULL AS DATE) AS list_date, CAST(NULL AS DATE) AS delist_date
        FROM (SELECT *, {_EXCHANGE} AS exchange FROM (SELECT {_SYM} AS symbol, name
            FROM (SELECT CAST(c_custkey * 7919 % 1000000 AS VARCHAR) AS c, c_name AS name FROM customer))) WHERE exchange IS NOT NULL""",
    "source_priority_pick": """SELECT ts_code, trade_date, max(value) AS close, 'first' AS source FROM ev WHERE value > 200
        GROUP BY ts_code, trade_date
        UNION ALL SELECT ts_code, trade_date, close, 'second' FROM bars2
        WHERE ts_code NOT IN (SELECT ts_code FROM ev WHERE value > 200)""",
    "source_windows": """SELECT ts_code, trade_date, close, 'first' AS source FROM rare JOIN asked_first USING (ts_code) WHERE trade_date BETWEEN lo AND hi
        UNION ALL SELECT ts_code, trade_date, close, 'second' FROM bars2 JOIN asked_second USING (ts_code) WHERE trade_date BETWEEN lo AND hi
        UNION ALL SELECT ts_code, trade_date, close, 'third' FROM bars JOIN asked_third USING (ts_code) WHERE trade_date BETWEEN lo AND hi""",
    "as_of_reports": """SELECT b.ts_code, b.trade_date, b.close, n.ann_date, n.end_date, n.eps, n.bps
        FROM order_bars b ASOF LEFT JOIN news_in_front n ON b.ts_code = n.ts_code AND b.trade_date >= n.ann_date""",
    "batch_union": f"""SELECT ts_code, trade_date, {_PRICES}, vol, CAST(NULL AS DOUBLE) AS adj_factor FROM bars
        UNION ALL SELECT ts_code, trade_date, NULL, NULL, NULL, close, NULL, NULL FROM bars2
        UNION ALL SELECT ts_code, trade_date, NULL, NULL, NULL, NULL, NULL, adj_factor FROM factors""",
    # sinks
    "upsert_bars_partial": _upsert(
        "SELECT * FROM bars WHERE trade_date <= DATE '2024-01-20'",
        "SELECT *, CAST(NULL AS DOUBLE) AS vol FROM bars2 WHERE trade_date >= DATE '2024-01-15'",
        ["ts_code", "trade_date"], ["close", "vol"],
        {"open": "NULL", "high": "NULL", "low": "NULL", "amount": "NULL"},
    ) .replace("SELECT ", "SELECT FALSE AS flag_extreme, FALSE AS flag_suspended, FALSE AS flag_aligned, FALSE AS flag_invalid_ohlc, ", 1),
    "upsert_rejects": f"""SELECT ts_code, trade_date, {_PRICES}, vol, 'stored' AS fate FROM bars WHERE close >= 10
        UNION ALL SELECT ts_code, NULL, {_PRICES}, vol, 'no value in the key (ts_code, trade_date)'
        FROM (SELECT DISTINCT ts_code, {_PRICES}, vol, amount FROM bars WHERE close < 10 OR close IS NULL)""",
    "upsert_duplicate_factors": f"{_BAR_STATE} FROM wideadj",
    "run_outcomes": """SELECT p.ts_code, CASE WHEN count(w.trade_date) > 0 THEN 'cleaned' ELSE 'failed' END AS outcome, count(w.trade_date) AS n_rows
        FROM instr p LEFT JOIN wide w ON w.ts_code = p.ts_code
        WHERE (p.ts_code LIKE '%.SZ' OR p.ts_code LIKE '%.SH') AND p.list_status = 'L' AND NOT contains(upper(p.name), 'ST')
            AND (p.list_date IS NULL OR p.list_date <= DATE '2024-01-30' - 25)
        GROUP BY p.ts_code""",
    "upsert_bars_fixed": _upsert(
        "SELECT *, CAST(NULL AS DOUBLE) AS pct_chg, CAST(NULL AS DOUBLE) AS adj_factor, CAST(NULL AS DOUBLE) AS raw_close,"
        " FALSE AS flag_extreme, FALSE AS flag_suspended FROM bars WHERE trade_date <= DATE '2024-01-20'",
        "SELECT * EXCLUDE (close), round(close + 1, 6) AS close, CAST(0 AS DOUBLE) AS pct_chg, CAST(1 AS DOUBLE) AS adj_factor,"
        " FALSE AS flag_extreme, vol = 0 AS flag_suspended FROM bars WHERE trade_date >= DATE '2024-01-11'",
        ["ts_code", "trade_date"],
        ["open", "high", "low", "close", "vol", "amount", "pct_chg", "adj_factor", "flag_extreme", "flag_suspended"],
        {"raw_close": "NULL"},
    ),
    "upsert_daily_basic": _upsert(
        "SELECT *, pe AS pe_ttm FROM basic_feed WHERE trade_date <= DATE '2024-01-20'",
        "SELECT * EXCLUDE (pb), round(pb + 1, 6) AS pb FROM basic_feed WHERE trade_date >= DATE '2024-01-11'",
        ["ts_code", "trade_date"], ["pe", "pb", "turnover_rate", "volume_ratio", "circ_mv", "total_mv"], {"pe_ttm": "NULL"},
    ),
    "upsert_financials": _upsert(
        "SELECT *, CAST(NULL AS DOUBLE) AS roe FROM reports WHERE year(end_date) <= 1998"
        " QUALIFY row_number() OVER (PARTITION BY ts_code, ann_date ORDER BY end_date) = 1",
        "SELECT * EXCLUDE (eps), round(eps + 1, 6) AS eps FROM reports WHERE year(end_date) >= 1997"
        " QUALIFY row_number() OVER (PARTITION BY ts_code, ann_date ORDER BY end_date) = 1",
        ["ts_code", "ann_date"], ["end_date", "eps", "bps"], {"roe": "NULL"},
    ),
    "upsert_name_history": _upsert(
        "SELECT * FROM hist WHERE start_date <= DATE '2024-01-20'",
        "SELECT * EXCLUDE (end_date), start_date + 5 AS end_date FROM hist WHERE start_date >= DATE '2024-01-11'",
        ["ts_code", "start_date", "name"], ["end_date", "change_reason", "is_st"], {},
    ),
    "upsert_source_audit": _audit("2024-01-10", "2024-01-25", "2024-02-01") + " UNION ALL " + _audit("2024-01-10", "2024-01-25", "2024-03-01"),
    "upsert_calendar": _upsert(
        "SELECT trade_date, is_open, trade_date - 1 AS pretrade_date, CAST(isodow(trade_date) - 1 AS INT) AS day_of_week,"
        " CAST(weekofyear(trade_date) AS INT) AS week_of_year, CAST(month(trade_date) AS INT) AS month,"
        " CAST(year(trade_date) AS INT) AS year FROM ocal WHERE year(trade_date) <= 1997",
        "SELECT trade_date, 1 - is_open AS is_open, trade_date - 7 AS pretrade_date, CAST(isodow(trade_date) - 1 AS INT) AS day_of_week,"
        " CAST(weekofyear(trade_date) AS INT) AS week_of_year, CAST(month(trade_date) AS INT) AS month,"
        " CAST(year(trade_date) AS INT) AS year FROM ocal WHERE year(trade_date) >= 1996",
        ["trade_date"], ["is_open", "pretrade_date", "day_of_week", "week_of_year", "month", "year"], {}, ("pretrade_date",),
    ),
    "upsert_instruments": _upsert(
        "SELECT *, DATE '2024-01-01' AS created_at, DATE '2024-01-01' AS updated_at FROM instr WHERE exchange <> 'BSE'",
        "SELECT * EXCLUDE (area, name, symbol), NULL AS area, name || ' B' AS name, 'changed' AS symbol, DATE '2024-02-01' AS created_at,"
        " DATE '2024-02-01' AS updated_at FROM instr WHERE exchange <> 'SSE'",
        ["ts_code"],
        ["symbol", "name", "exchange", "area", "industry", "list_date", "delist_date", "list_status", "created_at", "updated_at"],
        {}, ("symbol", "created_at", "updated_at"),
    ),
    "full_refresh_bars": f"""{_BAR_STATE} FROM wideadj UNION ALL
        SELECT ts_code, trade_date, open, high, low, 1, vol, amount, NULL, NULL, NULL, NULL, NULL, NULL, FALSE, FALSE, FALSE, FALSE
        FROM bars b WHERE trade_date <= DATE '2024-01-20' AND NOT EXISTS (
            SELECT 1 FROM wide w WHERE w.ts_code = b.ts_code AND w.trade_date = b.trade_date)""",
    "rebuild_bars": f"""SELECT 'old' AS which, ts_code, trade_date, open, high, low, CAST(1 AS DOUBLE) AS close, vol, CAST(NULL AS DOUBLE) AS pct_chg,
        FALSE AS flag_extreme, FALSE AS flag_suspended, FALSE AS flag_aligned, FALSE AS flag_invalid_ohlc
        FROM bars WHERE trade_date <= DATE '2024-01-20'
        UNION ALL SELECT 'new', ts_code, trade_date, {_PRICES}, vol, pct_chg, {_FLAGS} FROM wide""",
    "sql_store_day": """SELECT ts_code, trade_date, close, name, is_st_on_date, is_in_universe, exclude_reason
        FROM universe WHERE trade_date = DATE '2024-01-16'""",
    "quality_report_json": """SELECT CAST(trade_date AS VARCHAR) AS date, stock_count, status, quality_score, suspension_ratio,
        missing_high, extreme_count, extreme_ratio, date_min, date_max, n_anomalies FROM plain_report""",
    "run_log_fold": """SELECT id, run_date, CAST(start_time AS DATE) AS start_day, CAST(end_time AS DATE) AS end_day, status,
        n_lines AS stocks_fetched, n_lines AS stocks_cleaned, error_msg,
        round(CAST(epoch(end_time) - epoch(start_time) AS DOUBLE), 6) AS duration_sec FROM run_log""",
    "schema_evolve_read": """SELECT ts_code, trade_date, close, FALSE AS flag_extreme, vol = 0 AS flag_suspended, FALSE AS flag_aligned,
        FALSE AS flag_invalid_ohlc FROM bars""",
    # projections and filters
    "clean_numeric": """SELECT ts_code, trade_date, CASE WHEN vol <> 0 THEN open END AS open, high,
        CASE WHEN low >= 1 THEN low END AS low, CASE WHEN close <= 100 THEN close END AS close, vol, amount FROM bars""",
    "date_range_filter": "SELECT * FROM bars WHERE trade_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
    "daily_range": """SELECT ts_code, trade_date, close, vol FROM bars WHERE ts_code = '300007.SZ'
        AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
    "cross_section": """SELECT k.*, b.pe, b.pb, b.turnover_rate FROM bars k LEFT JOIN basics b
        ON k.ts_code = b.ts_code AND k.trade_date = b.trade_date WHERE k.trade_date = DATE '2024-01-16' AND k.close > 0""",
    "instruments_by_status": "SELECT * FROM instr WHERE list_status = 'D'",
    "stock_pool": _POOL,
    "flag_st_codes": """SELECT ts_code, trade_date, ts_code IN (SELECT ts_code FROM instr WHERE contains(upper(name), 'ST')) AS is_st
        FROM bars""",
    "flag_extreme": """SELECT ts_code, trade_date, close, (close / nullif(prev, 0) - 1) * 100 AS pct_chg,
        CASE WHEN prev = 0 THEN close <> 0 ELSE coalesce(abs((close / nullif(prev, 0) - 1) * 100) > 15, FALSE) END AS flag_extreme
        FROM (SELECT *, lag(close) OVER (PARTITION BY ts_code ORDER BY trade_date) AS prev FROM bars)""",
    "flag_invalid_ohlc": f"""SELECT ts_code, trade_date, {_PRICES}, ({_INVALID}) AS flag_invalid_ohlc, ({_INVALID}) AS flag_extreme
        FROM bars""",
    "flag_suspended": "SELECT ts_code, trade_date, vol, vol = 0 AS flag_suspended FROM bars",
    "exclude_reason": """SELECT coalesce(exclude_reason, 'none') AS reason, count(*) AS n_rows,
        count(*) FILTER (WHERE is_in_universe) AS n_in_universe FROM universe GROUP BY 1""",
    "research_universe": """SELECT ts_code, trade_date, close, pct_chg, name, industry, is_st_on_date, is_in_universe
        FROM universe WHERE trade_date = DATE '2024-01-16' AND is_in_universe""",
    # joins
    "adj_factor_join": "SELECT ts_code, trade_date, close, adj_factor FROM factor_join",
    "universe_meta_join": """SELECT k.ts_code, k.trade_date, k.close, s.name, s.area, s.industry, s.list_date, s.delist_date,
        s.ts_code IS NOT NULL AS has_meta FROM bars k LEFT JOIN instr_known s ON k.ts_code = s.ts_code""",
    "st_interval_join": """SELECT k.ts_code, k.trade_date, count(h.ts_code) AS n_intervals,
        count(*) FILTER (WHERE h.is_st) AS n_st_intervals FROM bars k LEFT JOIN hist h ON k.ts_code = h.ts_code
        AND k.trade_date >= h.start_date AND (h.end_date IS NULL OR k.trade_date <= h.end_date) GROUP BY 1, 2""",
    "source_compare": """SELECT a.ts_code, a.trade_date, a.close AS close_primary, b.close AS close_secondary,
        abs(a.close - b.close) / nullif(abs(a.close), 0) * 100 AS close_diff_pct
        FROM bars a JOIN bars2 b ON a.ts_code = b.ts_code AND a.trade_date = b.trade_date""",
    "calendar_align": f"""SELECT ts_code, trade_date, {_PRICES}, CASE WHEN flag_aligned THEN 0 ELSE vol END AS vol,
        CASE WHEN flag_aligned THEN 0 ELSE amount END AS amount, flag_aligned FROM clean_aligned""",
    "prev_trade_date": """SELECT trade_date, is_open, CASE WHEN is_open = 1 THEN (SELECT max(p.trade_date) FROM ocal p
        WHERE p.is_open = 1 AND p.trade_date < c.trade_date) END AS pretrade_date FROM ocal c""",
    "incremental_plan": """SELECT i.ts_code, coalesce(greatest(DATE '2024-01-05', l.latest - 10), DATE '2024-01-05') AS start_date
        FROM instr i LEFT JOIN (SELECT ts_code, max(trade_date) AS latest FROM bars WHERE trade_date <= DATE '2024-01-20' GROUP BY 1) l
        ON i.ts_code = l.ts_code WHERE l.latest IS NULL OR l.latest < DATE '2024-01-20'""",
    # aggregations
    "latest_date": "SELECT max(trade_date) AS latest_date FROM bars",
    "latest_date_one": "SELECT max(trade_date) AS latest_date FROM bars WHERE ts_code = '300007.SZ'",
    "latest_date_by_stock": "SELECT ts_code, max(trade_date) AS latest_date FROM bars GROUP BY ts_code",
    "stock_count": """SELECT 'day' AS scope, count(DISTINCT ts_code) AS stock_count FROM bars WHERE trade_date = DATE '2024-01-16'
        UNION ALL SELECT 'all', count(DISTINCT ts_code) FROM bars""",
    "table_row_counts": """SELECT 'daily_kline' AS table_name, count(*) AS n_rows FROM bars
        UNION ALL SELECT 'daily_basic', count(*) FROM basics UNION ALL SELECT 'financial_indicators', count(*) FROM reports
        UNION ALL SELECT 'trade_calendar', count(*) FROM cal UNION ALL SELECT 'stock_list', count(*) FROM instr""",
    "date_range": "SELECT min(trade_date) AS date_min, max(trade_date) AS date_max FROM bars",
    "st_on_date": """SELECT ts_code, trade_date, (SELECT count(*) FROM hist WHERE is_st AND hist.ts_code = b.ts_code
        AND start_date <= b.trade_date AND (end_date IS NULL OR end_date >= b.trade_date)) > 0 AS is_st_on_date FROM bars b""",
    "missing_rates": "SELECT trade_date, field, rate FROM missing",
    "extreme_stats": """SELECT trade_date, extreme_count, extreme_ratio, move_min, move_max FROM day_stats WHERE extreme_count > 0""",
    "suspension_stats": "SELECT trade_date, stock_count, suspension_count, suspension_ratio, invalid_ohlc_count FROM day_stats",
    "outlier_mad": f"""SELECT b.ts_code, b.trade_date, b.close,
        coalesce(s.n >= 10 AND s.mad <> 0 AND abs(b.close - s.med) / nullif(s.mad, 0) > 5, FALSE) AS is_outlier
        FROM bars b JOIN ({_MAD}) s ON b.ts_code = s.ts_code""",
    "outlier_zscore": _outlier(
        "s.sd <> 0 AND abs(b.close - s.mean) / nullif(s.sd, 0) > 3", "avg(close) AS mean, stddev_samp(close) AS sd"
    ),
    "outlier_iqr": _outlier(
        "s.q3 <> s.q1 AND (b.close < s.q1 - 1.5 * (s.q3 - s.q1) OR b.close > s.q3 + 1.5 * (s.q3 - s.q1))",
        "quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.75) AS q3",
    ),
    "winsorize": f"""SELECT b.ts_code, b.trade_date, b.close,
        round(CASE WHEN m.mad = 0 THEN b.close ELSE greatest(m.med - 5 * m.mad, least(m.med + 5 * m.mad, b.close)) END, 6) AS close_mad,
        round(CASE WHEN s.sd IS NULL OR s.sd = 0 THEN b.close ELSE greatest(s.mean - 3 * s.sd, least(s.mean + 3 * s.sd, b.close)) END, 6)
            AS close_zscore,
        round(CASE WHEN s.q1 = s.q3 THEN b.close ELSE greatest(s.q1 - 1.5 * (s.q3 - s.q1), least(s.q3 + 1.5 * (s.q3 - s.q1), b.close)) END, 6)
            AS close_iqr
        FROM bars b JOIN ({_MAD}) m ON b.ts_code = m.ts_code
        JOIN (SELECT ts_code, avg(close) AS mean, stddev_samp(close) AS sd, quantile_cont(close, 0.25) AS q1,
            quantile_cont(close, 0.75) AS q3 FROM bars GROUP BY ts_code) s ON b.ts_code = s.ts_code""",
    "source_audit": _audit("2024-01-10", "2024-01-25", "2024-02-01"),
    "days_since_success": """SELECT max(run_date) AS last_success, CAST(DATE '2001-08-05' - max(run_date) AS INT) AS days_since,
        max(run_date) IS NULL OR DATE '2001-08-05' - max(run_date) >= 7 AS maintenance_due FROM run_log WHERE status = 'success'""",
    "open_days_per_year": """SELECT CAST(year(trade_date) AS INT) AS year, CAST(sum(is_open) AS BIGINT) AS open_days FROM ocal GROUP BY 1""",
    "run_status": """SELECT t.*, r.status AS report_status, CASE WHEN stocks_failed > 0 AND stocks_cleaned = 0 AND stocks_up_to_date = 0 THEN 'failed'
        WHEN stocks_failed > 0 OR r.status = 'critical' THEN 'partial' ELSE 'success' END AS status FROM (
        SELECT trade_date, count(*) FILTER (WHERE o = 'c') AS stocks_fetched, count(*) FILTER (WHERE o = 'c') AS stocks_cleaned,
            count(*) FILTER (WHERE o = 'f') AS stocks_failed, count(*) FILTER (WHERE o = 'u') AS stocks_up_to_date,
            CAST(coalesce(sum(vol) FILTER (WHERE o = 'c'), 0) AS BIGINT) AS kline_rows
        FROM (SELECT *, CASE WHEN vol = 0 THEN 'f' WHEN isodow(trade_date) >= 6 THEN 'u' ELSE 'c' END AS o FROM bars)
        GROUP BY trade_date) t LEFT JOIN plain_report r USING (trade_date)""",
    "quality_score": "SELECT trade_date, quality_score FROM plain_report",
    "quality_anomalies": "SELECT * FROM plain_anomalies",
    "quality_status": "SELECT trade_date, status FROM plain_report",
    "quality_report": "SELECT * FROM full_report",
    "quality_summary": """SELECT trade_date, CASE status WHEN 'normal' THEN '✅' WHEN 'warning' THEN '⚠️' ELSE '🚨' END || ' 数据质量 | '
        || CAST(trade_date AS VARCHAR) || ' | 股票 ' || CAST(stock_count AS VARCHAR) || ' | 得分 ' || CAST(quality_score AS VARCHAR)
        || ' | 异常 ' || CAST(n_anomalies AS VARCHAR) || ' 项 | 状态 ' || status AS summary FROM plain_report""",
    # series
    "pct_chg": """SELECT ts_code, trade_date, close, (close / nullif(lag(close) OVER (PARTITION BY ts_code ORDER BY trade_date), 0)
        - 1) * 100 AS pct_chg FROM bars""",
    "log_ret": """SELECT ts_code, trade_date, close, round(CASE WHEN close > 0 AND prev > 0 THEN ln(close / prev) END, 6) AS log_ret
        FROM (SELECT *, lag(close) OVER (PARTITION BY ts_code ORDER BY trade_date) AS prev FROM bars)""",
    "forward_fill": "SELECT ts_code, trade_date, "
    + ", ".join(
        f"(SELECT max_by(p.{c}, p.trade_date) FROM bars p WHERE p.ts_code = b.ts_code AND p.trade_date <= b.trade_date"
        f" AND p.{c} IS NOT NULL) AS {c}"
        for c in ("open", "high", "low", "close")
    )
    + ", vol FROM bars b",
    "fill_both_ways": "SELECT ts_code, trade_date, adj_factor FROM factor_filled",
    "adjust_none": f"""SELECT ts_code, trade_date, CAST(NULL AS DOUBLE) AS adj_factor, open AS adj_open, high AS adj_high,
        low AS adj_low, close AS adj_close FROM bars""",
    "adjust_hfq": _adjusted("head"),
    "adjust_qfq": _adjusted("tail"),
    "dedup_first": """SELECT * FROM ticks QUALIFY row_number() OVER (PARTITION BY ts_code, trade_date ORDER BY ingest_seq) = 1""",
    "aligned_returns": """SELECT ts_code, trade_date, flag_aligned, pct_chg, round(log_ret, 6) AS log_ret FROM clean""",
    # top-k, sets, scalars
    "recent_trade_dates": """SELECT trade_date FROM cal WHERE is_open = 1 AND trade_date <= DATE '2024-01-16'
        ORDER BY trade_date DESC LIMIT 5""",
    "recent_runs": "SELECT id, run_date, status, n_lines AS stocks_fetched FROM run_log ORDER BY run_date DESC, id DESC LIMIT 10",
    "head_n_codes": f"SELECT ts_code FROM ({_POOL}) ORDER BY ts_code LIMIT 5",
    "missing_top5": """SELECT trade_date, field, rate, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (
        PARTITION BY trade_date ORDER BY rate DESC, position) AS place FROM missing) WHERE place <= 5""",
    "build_calendar": """SELECT trade_date FROM cal WHERE is_open = 1 AND year(trade_date) BETWEEN 1996 AND 2024
        UNION SELECT trade_date FROM ocal WHERE is_open = 1 AND year(trade_date) BETWEEN 1996 AND 2024""",
    "sym_exchange_map": f"""SELECT symbol, {_EXCHANGE} AS exchange, symbol || CASE {_EXCHANGE} WHEN 'SSE' THEN '.SH'
        WHEN 'SZSE' THEN '.SZ' ELSE '.BJ' END AS ts_code, symbol AS back
        FROM (SELECT {_SYM} AS symbol FROM (SELECT CAST(c_custkey * 7919 % 1000000 AS VARCHAR) AS c FROM customer))""",
    "date_normalize": """SELECT o_orderkey, request_date, request_date - 10 AS overlap_date,
        (SELECT count(*) FROM (SELECT unnest(generate_series(0, 10)) AS k) WHERE isodow(request_date - CAST(k AS INT)) < 6
            AND request_date IS NOT NULL) + CASE WHEN request_date IS NULL THEN NULL ELSE 0 END AS business_days, price
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) OR o_orderkey % 16 = 15 THEN CAST(o_orderdate AS DATE)
            WHEN o_orderkey % 4 = 2 THEN DATE '2024-02-01' END AS request_date,
            CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price FROM orders)""",
    "calendar_parts": """SELECT trade_date, is_open, CAST(isodow(trade_date) - 1 AS INT) AS day_of_week,
        CAST(weekofyear(trade_date) AS INT) AS week_of_year, CAST(month(trade_date) AS INT) AS month,
        CAST(year(trade_date) AS INT) AS year FROM ocal""",
    # dataflows
    "clean_bars": f"""SELECT ts_code, trade_date, {_PRICES}, vol, amount, pct_chg, round(log_ret, 6) AS log_ret,
        {_FLAGS} FROM clean""",
    "clean_supplier_bars": f"""SELECT ts_code, trade_date, {_PRICES}, vol, pct_chg, round(log_ret, 6) AS log_ret, {_FLAGS} FROM sclean""",
    "clean_and_adjust": f"""SELECT ts_code, trade_date, {_PRICES}, vol, pct_chg,
        adj_factor, {_QFQ}, {_FLAGS} FROM cleanadj""",
    "research_universe_view": """SELECT ts_code, trade_date, close, pct_chg, name, list_status, is_st_on_date,
        is_listed_on_date, is_in_universe, exclude_reason FROM universe""",
    "incremental_merge": f"{_BAR_STATE} FROM wideadj",
    "source_audit_sample": _audit(
        "2024-01-20", "2024-01-25", "2024-02-01", f"(SELECT ts_code FROM ({_POOL}) ORDER BY ts_code LIMIT 10)", "bars2"
    ),
    "stream_upsert_bars": """SELECT ts_code, trade_date, open, high, low, CASE WHEN trade_date >= DATE '2024-01-15' THEN close + 1 ELSE close END AS close,
        vol, amount, FALSE AS flag_extreme, FALSE AS flag_suspended, FALSE AS flag_aligned, FALSE AS flag_invalid_ohlc FROM bars""",
    "raw_sql": """SELECT trade_date, count(*) AS n_rows, max(close) AS top_close FROM bars
        WHERE trade_date >= DATE '2024-01-10' AND close > 10 GROUP BY trade_date""",
}


def oracle() -> dict[str, str]:
    return {name: _with(body) for name, body in BODIES.items()}
