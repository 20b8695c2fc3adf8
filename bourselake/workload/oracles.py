"""SQL oracles for the registered queries, written for DuckDB.

They use other methods than the Spark operators: literal holiday lists instead
of holiday rules, one row per day instead of day masks, ranks of sessions within
a month instead of running session numbers.
"""

from __future__ import annotations

# Weekday closures and early closes, as published.
CMES_CLOSED = """
2014-01-01 2014-04-18 2014-12-25 2015-01-01 2015-04-03 2015-12-25 2016-01-01
2016-03-25 2016-12-26 2017-01-02 2017-04-14 2017-12-25 2018-01-01 2018-03-30
2018-12-25 2019-01-01 2019-04-19 2019-12-25 2020-01-01 2020-04-10 2020-12-25
2021-01-01 2021-04-02 2021-12-24 2022-04-15 2022-12-26 2023-01-02 2023-04-07
2023-12-25 2024-01-01 2024-03-29 2024-12-25 2025-01-01 2025-04-18 2025-12-25
""".split()
XNYS_CLOSED = """
2015-01-01 2015-01-19 2015-02-16 2015-04-03 2015-05-25 2015-07-03 2015-09-07
2015-11-26 2015-12-25 2016-01-01 2016-01-18 2016-02-15 2016-03-25 2016-05-30
2016-07-04 2016-09-05 2016-11-24 2016-12-26 2017-01-02 2017-01-16 2017-02-20
2017-04-14 2017-05-29 2017-07-04 2017-09-04 2017-11-23 2017-12-25 2018-01-01
2018-01-15 2018-02-19 2018-03-30 2018-05-28 2018-07-04 2018-09-03 2018-11-22
2018-12-05 2018-12-25 2019-01-01 2019-01-21 2019-02-18 2019-04-19 2019-05-27
2019-07-04 2019-09-02 2019-11-28 2019-12-25 2020-01-01 2020-01-20 2020-02-17
2020-04-10 2020-05-25 2020-07-03 2020-09-07 2020-11-26 2020-12-25 2021-01-01
2021-01-18 2021-02-15 2021-04-02 2021-05-31 2021-07-05 2021-09-06 2021-11-25
2021-12-24 2023-12-25 2024-01-01 2024-01-15 2024-02-19 2024-03-29
""".split()
# Early closes on the days around the federal holidays, 2015-2021 and early 2024.
CMES_EARLY = """
2015-01-19 2015-02-16 2015-05-25 2015-07-03 2015-09-07 2015-11-26 2015-11-27
2015-12-24 2016-01-18 2016-02-15 2016-05-30 2016-07-04 2016-09-05 2016-11-24
2016-11-25 2017-01-16 2017-02-20 2017-05-29 2017-07-04 2017-09-04 2017-11-23
2017-11-24 2018-01-15 2018-02-19 2018-05-28 2018-07-04 2018-09-03 2018-11-22
2018-11-23 2018-12-24 2019-01-21 2019-02-18 2019-05-27 2019-07-04 2019-09-02
2019-11-28 2019-11-29 2019-12-24 2020-01-20 2020-02-17 2020-05-25 2020-07-03
2020-09-07 2020-11-26 2020-11-27 2020-12-24 2021-01-18 2021-02-15 2021-05-31
2021-07-05 2021-09-06 2021-11-25 2021-11-26 2024-01-15 2024-02-19
""".split()
XNYS_EARLY = """
2015-11-27 2015-12-24 2016-11-25 2017-07-03 2017-11-24 2018-07-03 2018-11-23
2018-12-24 2019-07-03 2019-11-29 2019-12-24 2020-11-27 2020-12-24 2021-11-26
""".split()
# IEPA trades in full on the day after Thanksgiving and on Christmas Eve.
IEPA_EARLY = [
    d
    for d in CMES_EARLY
    if d[5:] != "12-24"
    and d
    not in (
        "2015-11-27",
        "2016-11-25",
        "2017-11-24",
        "2018-11-23",
        "2019-11-29",
        "2020-11-27",
        "2021-11-26",
    )
]
# First days of daylight saving and of standard time.
DAYLIGHT = """
2015-03-08 2015-11-01 2016-03-13 2016-11-06 2017-03-12 2017-11-05 2018-03-11
2018-11-04 2019-03-10 2019-11-03 2020-03-08 2020-11-01 2021-03-14 2021-11-07
2024-03-10 2024-11-03
""".split()


def _dates(name: str, by_calendar: dict[str, list[str]]) -> str:
    rows = ", ".join(
        f"('{calendar}', DATE '{day}')"
        for calendar, days in by_calendar.items()
        for day in days
    )
    return f"{name}(calendar, day) AS (VALUES {rows})"


CALENDAR = ",\n".join(
    [
        _dates(
            "closed", {"CMES": CMES_CLOSED, "IEPA": CMES_CLOSED, "XNYS": XNYS_CLOSED}
        ),
        _dates("early", {"CMES": CMES_EARLY, "IEPA": IEPA_EARLY, "XNYS": XNYS_EARLY}),
        "daylight(first, last) AS (VALUES "
        + ", ".join(
            f"(DATE '{a}', DATE '{b}')"
            for a, b in zip(DAYLIGHT[::2], DAYLIGHT[1::2], strict=True)
        )
        + ")",
        """
cal AS (
  SELECT c.calendar, d.day,
         isodow(d.day) < 6 AND x.day IS NULL AS is_session,
         e.day IS NOT NULL AS is_early_close
  FROM (VALUES ('CMES'), ('IEPA'), ('XNYS')) c(calendar)
  CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '2014-01-01',
              DATE '2025-12-31', INTERVAL 1 DAY)) AS DATE) AS day) d
  LEFT JOIN closed x ON x.calendar = c.calendar AND x.day = d.day
  LEFT JOIN early e ON e.calendar = c.calendar AND e.day = d.day)""",
    ]
)

ROOTS = (
    "['EMD','ES','GC','HG','M2K','MES','MNQ','MYM','NIY','NKD','NQ',"
    "'PA','PL','RTY','SI','UB','YM','ZB','ZF','ZN','ZT']"
)
TREASURY = "('UB','ZB','ZF','ZN','ZT')"
METALS = "('GC','HG','PA','PL','SI')"
LETTERS = "'FGHJKMNQUVXZ'"

TICKS = f"""
ticks AS (
  SELECT event_id, user_id, value, event_type,
    CASE event_type WHEN 'click' THEN 'GLBX.MDP3' WHEN 'view' THEN 'OPRA.PILLAR'
      WHEN 'purchase' THEN 'XNAS.ITCH' WHEN 'signup' THEN 'DBEQ.BASIC'
      ELSE 'UNKNOWN.DATASET' END AS dataset,
    {ROOTS}[(user_id % 21) + 1] || CASE user_id % 5 WHEN 0 THEN '.c.0'
      WHEN 1 THEN '.v.0' WHEN 2 THEN '.FUT'
      ELSE ['H24','M24','U24','Z24'][((user_id // 21) % 4) + 1] END AS symbol,
    'trades' AS schema_, CAST(ts AS DATE) AS trade_date,
    epoch_us(ts) * 1000 AS ts_event_ns,
    CAST(round(value * 100) AS BIGINT) AS price_cents, length(props) AS n_bytes
  FROM events),
tick_calendar AS (
  SELECT *, CASE dataset WHEN 'GLBX.MDP3' THEN 'CMES' ELSE 'XNYS' END AS calendar,
    CASE dataset WHEN 'GLBX.MDP3' THEN DATE '2024-01-04'
      WHEN 'OPRA.PILLAR' THEN DATE '2024-01-12' WHEN 'XNAS.ITCH' THEN DATE '2024-01-31'
      WHEN 'DBEQ.BASIC' THEN DATE '2024-01-20'
      ELSE DATE '2024-01-26' END AS snapshot_date
  FROM ticks)"""

BARS = f"""
bars AS (
  SELECT CASE l_linestatus WHEN 'F' THEN 'IFUS.IMPACT' ELSE 'GLBX.MDP3' END AS dataset,
    'I' || l_partkey AS symbol, 'ohlcv-1d' AS schema_,
    {ROOTS}[(l_partkey % 21) + 1] AS root, l_suppkey AS book,
    CASE l_returnflag WHEN 'A' THEN 'ohlcv-1d' WHEN 'N' THEN 'ohlcv-1h'
      ELSE 'ohlcv-1m' END AS feed,
    CAST(l_shipdate + INTERVAL 20 YEAR AS DATE) AS trade_date,
    CAST(l_quantity AS BIGINT) AS volume, l_discount >= 0.095 AS is_degraded,
    l_linenumber AS line, l_returnflag = 'R' AS is_returned
  FROM lineitem)"""

BOTH = """
both_rows AS (SELECT dataset, symbol, schema_, trade_date FROM ticks
  UNION ALL SELECT dataset, symbol, schema_, trade_date FROM bars)"""

TICK_REQUESTS = """
tick_requests AS (
  SELECT d.dataset, s.symbol, 'trades' AS schema_,
    DATE '2024-01-01' + CAST((7 * u) % 26 AS INTEGER) AS range_start,
    DATE '2024-01-01' + CAST((7 * u) % 26 + u % 5 AS INTEGER) AS range_end
  FROM (SELECT symbol, min(user_id) AS u FROM ticks GROUP BY symbol) s
  CROSS JOIN (VALUES ('GLBX.MDP3'), ('OPRA.PILLAR'), ('XNAS.ITCH'), ('DBEQ.BASIC'),
    ('UNKNOWN.DATASET')) d(dataset))"""

BAR_REQUESTS = """
bar_requests AS (
  SELECT DISTINCT dataset, symbol, schema_, DATE '2015-01-01' AS range_start,
    DATE '2021-12-31' AS range_end FROM bars)"""

# Expected partitions of all requests, one row each.
EXPECTED = """
requests AS (SELECT * FROM tick_requests UNION ALL SELECT * FROM bar_requests),
expected AS (
  SELECT r.*, year(c.day) AS year, month(c.day) AS month, day(c.day) AS day,
    c.day AS part_start, c.day AS part_end
  FROM tick_requests r JOIN cal c
    ON c.calendar = CASE r.dataset WHEN 'GLBX.MDP3' THEN 'CMES' ELSE 'XNYS' END
   AND c.is_session AND c.day BETWEEN r.range_start AND r.range_end
  UNION ALL
  SELECT r.*, year(m.first) AS year, month(m.first) AS month, 0 AS day,
    greatest(m.first, r.range_start) AS part_start,
    least(last_day(m.first), r.range_end) AS part_end
  FROM bar_requests r JOIN (SELECT CAST(unnest(generate_series(DATE '2014-01-01',
    DATE '2022-12-01', INTERVAL 1 MONTH)) AS DATE) AS first) m
    ON m.first <= r.range_end AND last_day(m.first) >= r.range_start),
present AS (
  SELECT DISTINCT dataset, symbol, schema_, year(trade_date) AS year,
    month(trade_date) AS month,
    CASE schema_ WHEN 'trades' THEN day(trade_date) ELSE 0 END AS day
  FROM both_rows),
missing AS (
  SELECT e.* FROM expected e ANTI JOIN present p
    USING (dataset, symbol, schema_, year, month, day))"""

ALL_REQUESTS = ",".join(
    [CALENDAR, TICKS, BARS, BOTH, TICK_REQUESTS, BAR_REQUESTS, EXPECTED]
)

PARTITION = (
    "CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, "
    "CAST(day AS BIGINT) AS day"
)


def _islands(source: str, keys: str, extra: str = "") -> str:
    """Maximal runs of consecutive days of a (keys, day) relation."""
    return f"""
SELECT {keys}, min(day) AS range_start, max(day) AS range_end{extra} FROM (
  SELECT {keys}, day, day - CAST(row_number() OVER (PARTITION BY {keys}
    ORDER BY day) AS INTEGER) AS island
  FROM (SELECT DISTINCT {keys}, day FROM {source}))
GROUP BY {keys}, island"""


KEY = "dataset, symbol, schema_"

RECORDED_DAYS = """
recorded AS (SELECT dataset, symbol, schema_, trade_date AS range_start,
  trade_date + CAST(line * 5 AS INTEGER) AS range_end FROM bars),
recorded_days AS (SELECT DISTINCT dataset, symbol, schema_,
  CAST(unnest(generate_series(range_start, range_end, INTERVAL 1 DAY)) AS DATE) AS day
  FROM recorded)"""

CATALOG = f"""
loaded AS (SELECT dataset, symbol, schema_, trade_date AS day FROM tick_calendar
  WHERE trade_date <= snapshot_date),
catalog AS (
  SELECT {KEY}, min(day) AS range_start, max(day) AS range_end FROM loaded
  WHERE dataset = 'XNAS.ITCH' GROUP BY {KEY}
  UNION ALL
  SELECT * FROM ({_islands("loaded WHERE dataset <> 'XNAS.ITCH'", KEY)}))"""

# Contracts of all months 2014-2024, all 21 roots.
CONTRACTS = f"""
sessions AS (SELECT day, date_trunc('month', day) AS month_start,
    row_number() OVER (PARTITION BY date_trunc('month', day) ORDER BY day DESC) AS from_end
  FROM cal WHERE calendar = 'CMES' AND is_session),
fridays AS (SELECT date_trunc('month', day) AS month_start, max(day) AS friday FROM cal
  WHERE calendar = 'CMES' AND isodow(day) = 5 AND day(day) BETWEEN 15 AND 21 GROUP BY 1),
month_expiry AS (
  SELECT 'third_friday' AS rule, f.month_start, max(s.day) AS expiration
  FROM fridays f JOIN sessions s ON s.day <= f.friday AND s.day > f.friday - 10
  GROUP BY f.month_start
  UNION ALL SELECT 'treasury', month_start, day FROM sessions WHERE from_end = 8
  UNION ALL SELECT 'metals', month_start, day FROM sessions WHERE from_end = 3),
roots AS (SELECT root, CASE WHEN root IN {TREASURY} THEN 'treasury'
    WHEN root IN {METALS} THEN 'metals' ELSE 'third_friday' END AS rule
  FROM (SELECT unnest({ROOTS}) AS root)),
expiry AS (
  SELECT r.root, r.rule, CAST(year(month_start) AS BIGINT) AS year,
    CAST(month(month_start) AS BIGINT) AS month, expiration,
    r.root || substr({LETTERS}, CAST(month(month_start) AS INTEGER), 1)
      || lpad(CAST(year(month_start) % 100 AS VARCHAR), 2, '0') AS symbol
  FROM roots r JOIN month_expiry USING (rule)),
quarters AS (
  SELECT *, lag(symbol) OVER w AS previous_symbol, lead(symbol) OVER w AS next_symbol,
    lag(expiration) OVER w AS previous_expiration,
    lag(expiration) OVER w - 14 AS window_start
  FROM expiry WHERE month IN (3, 6, 9, 12)
  WINDOW w AS (PARTITION BY root ORDER BY year, month))"""

SLICED = """
sliced AS (SELECT b.book, b.dataset, b.root, b.feed, b.trade_date, b.volume,
    b.is_degraded, q.symbol, q.window_start, q.expiration
  FROM bars b JOIN quarters q
    ON q.root = b.root AND b.trade_date BETWEEN q.window_start AND q.expiration),
holdings AS (
  SELECT book, dataset, symbol, feed AS schema_,
    greatest(CAST(date_trunc('month', min(trade_date)) AS DATE), min(window_start))
      AS range_start,
    least(last_day(max(trade_date)), min(expiration)) AS range_end,
    CAST(sum(volume) AS BIGINT) AS size_bytes,
    CAST(count(*) FILTER (WHERE is_degraded) AS BIGINT) AS n_issues
  FROM sliced GROUP BY book, dataset, symbol, feed),
held AS (SELECT h.*, q.root, q.year, q.month, q.expiration,
    CAST(q.year * 4 + q.month // 3 AS BIGINT) AS quarter_no
  FROM holdings h JOIN quarters q USING (symbol)),
held_groups AS (
  SELECT book, dataset, root, schema_, count(*) AS n_contracts,
    arg_min(symbol, quarter_no) AS first_symbol,
    arg_max(symbol, quarter_no) AS last_symbol,
    CAST(sum(size_bytes) AS BIGINT) AS size_bytes,
    CAST(sum(n_issues) AS BIGINT) AS n_issues, count(DISTINCT quarter_no) AS n_quarterly,
    max(quarter_no) - min(quarter_no) + 1 AS expected_quarterly
  FROM held GROUP BY book, dataset, root, schema_)"""

HOLDINGS = ",".join([CALENDAR, BARS, CONTRACTS, SLICED])

FEED_ROOTS = ROOTS[:-1] + ",'AAPL','CL','VX','ZC']"
FEED = f"""
feed AS (
  SELECT CAST(l_quantity AS BIGINT) AS volume, CASE l_linenumber
    WHEN 1 THEN root || letter || lpad(yy, 2, '0')
    WHEN 2 THEN lower(root || letter || lpad(yy, 2, '0'))
    WHEN 3 THEN root || '.' || ['c','v','n'][(l_suppkey % 3) + 1] || '.0'
    WHEN 4 THEN lower(root) || '.c.1'
    WHEN 5 THEN root || ['.FUT','.OPT','.SPOT'][(l_suppkey % 3) + 1]
    WHEN 6 THEN root || letter || substr(yy, 1, 1)
    ELSE CASE WHEN l_suppkey % 2 = 0 THEN lower(root) ELSE root END END AS symbol
  FROM (SELECT *, {FEED_ROOTS}[(l_partkey % 25) + 1] AS root,
      substr({LETTERS}, CAST(l_suppkey % 12 AS INTEGER) + 1, 1) AS letter,
      CAST(l_orderkey % 30 AS VARCHAR) AS yy FROM lineitem)),
feed_symbols AS (SELECT symbol, CAST(sum(volume) AS BIGINT) AS volume,
    regexp_matches(symbol, '^[A-Za-z0-9]{{1,4}}[FGHJKMNQUVXZfghjkmnquvxz][0-9]{{2}}$')
      AS parses
  FROM feed GROUP BY symbol),
parsed AS (
  SELECT symbol, volume, upper(left(symbol, length(symbol) - 3)) AS root,
    2000 + CAST(right(symbol, 2) AS BIGINT) AS year,
    CAST(strpos({LETTERS}, upper(substr(symbol, length(symbol) - 2, 1))) AS BIGINT)
      AS month
  FROM feed_symbols WHERE parses),
supported AS (SELECT * FROM parsed WHERE list_contains({ROOTS}, root))"""

NOTICES = """
issues_raw AS (
  SELECT 'GLBX.MDP3' AS dataset, symbol, schema_, event_id AS arrival, 0 AS place,
    trade_date AS issue_date,
    CASE WHEN value < 20 THEN 'degraded' ELSE 'missing' END AS issue_type, *
    EXCLUDE (dataset, symbol, schema_)
  FROM ticks WHERE event_type = 'error'),
issue_texts AS (SELECT *, 'The request has reduced quality: '
    || CAST(trade_date AS VARCHAR) || ' (' || issue_type || '), '
    || CAST(trade_date + CAST(user_id % 7 AS INTEGER) AS VARCHAR)
    || ', , 2024-02-30 (missing). See the notes.' AS message FROM issues_raw),
issues_all AS (
  SELECT dataset, symbol, schema_, arrival, 0 AS place, issue_date, issue_type,
    message, trade_date FROM issue_texts
  UNION ALL
  SELECT dataset, symbol, schema_, arrival, 1, trade_date + CAST(user_id % 7 AS INTEGER),
    'degraded', message, trade_date FROM issue_texts),
issues AS (SELECT * FROM issues_all QUALIFY row_number() OVER (
    PARTITION BY dataset, symbol, schema_, issue_date ORDER BY arrival, place) = 1)"""

ISSUES = ",".join([TICKS, NOTICES])

FOLDERS = f"dataset, schema_, {PARTITION}"

ORACLES: dict[str, str] = {}


def _oracle(name: str, *ctes: str, select: str) -> None:
    head = "WITH " + ",".join(ctes) + "\n" if ctes else ""
    ORACLES[name] = head + select


# --- sources and sinks -----------------------------------------------------

IN_WINDOW = "trade_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-19'"
TICK_FOLDER = (
    "dataset, schema_, CAST(year(trade_date) AS BIGINT) AS year, "
    "CAST(month(trade_date) AS BIGINT) AS month, CAST(day(trade_date) AS BIGINT) AS day"
)

_oracle(
    "windowed_read",
    TICKS,
    select=f"""SELECT event_id, {KEY}, ts_event_ns, trade_date, price_cents
FROM ticks WHERE {IN_WINDOW}""",
)
_oracle(
    "partition_load",
    TICKS,
    select=f"""SELECT {TICK_FOLDER}, count(*) AS n_rows FROM ticks
WHERE {IN_WINDOW} GROUP BY ALL""",
)
_oracle(
    "partition_replace",
    TICKS,
    select=f"""SELECT {TICK_FOLDER}, count(*) AS n_rows,
  CAST(sum(CASE WHEN dataset = 'XNAS.ITCH' AND symbol[1] = 'N' AND trade_date BETWEEN DATE '2024-01-10'
    AND DATE '2024-01-12' THEN 2 * price_cents ELSE price_cents END) AS BIGINT)
    AS price_cents
FROM ticks GROUP BY ALL""",
)
_oracle(
    "partition_assign",
    TICKS,
    BARS,
    BOTH,
    select=f"""SELECT {KEY}, year(trade_date) AS year, month(trade_date) AS month,
  CASE schema_ WHEN 'trades' THEN day(trade_date) ELSE 0 END AS day,
  count(*) AS n_rows, CASE schema_ WHEN 'trades' THEN 'day' ELSE 'month' END AS grain,
  left(CAST(trade_date AS VARCHAR), CASE schema_ WHEN 'trades' THEN 10 ELSE 7 END)
    AS label
FROM both_rows GROUP BY ALL""",
)
_oracle(
    "partition_list",
    ALL_REQUESTS,
    select=f"""SELECT r.{KEY.replace(", ", ", r.")}, r.range_start, r.range_end,
  p.year, p.month, p.day,
  CASE WHEN p.day > 0 THEN make_date(p.year, p.month, p.day)
    ELSE greatest(make_date(p.year, p.month, 1), r.range_start) END AS part_start,
  CASE WHEN p.day > 0 THEN make_date(p.year, p.month, p.day)
    ELSE least(last_day(make_date(p.year, p.month, 1)), r.range_end) END AS part_end
FROM requests r JOIN present p USING (dataset, symbol, schema_)
WHERE CASE WHEN p.day > 0
  THEN make_date(p.year, p.month, p.day) BETWEEN r.range_start AND r.range_end
  ELSE make_date(p.year, p.month, 1) <= r.range_end
    AND last_day(make_date(p.year, p.month, 1)) >= r.range_start END""",
)
_oracle(
    "layout_import",
    TICKS,
    BARS,
    BOTH,
    select="""SELECT dataset, replace(symbol, '.', '_') AS symbol, schema_,
  year(trade_date) AS year, month(trade_date) AS month,
  CASE schema_ WHEN 'trades' THEN day(trade_date) ELSE 0 END AS day,
  count(*) AS n_rows FROM both_rows GROUP BY ALL""",
)
MINUTE_KEY = "dataset, replace(symbol, '.', '_') AS symbol, 'ohlcv-1m' AS schema_"
_oracle(
    "layout_export_import",
    TICKS,
    select=f"""SELECT {MINUTE_KEY}, year(trade_date) AS year, month(trade_date) AS month,
  0 AS day, count(*) AS n_rows FROM ticks GROUP BY ALL""",
)
_oracle(
    "layout_sizes",
    TICKS,
    select=f"""SELECT {MINUTE_KEY},
  count(DISTINCT date_trunc('month', trade_date)) AS n_partitions,
  count(*) AS n_rows, true AS sizes_agree FROM ticks GROUP BY ALL""",
)
_oracle(
    "size_rollup",
    select="""SELECT source, lang, CAST(sum(n_chars) AS BIGINT) AS size_bytes,
  count(*) AS n_files FROM documents GROUP BY source, lang""",
)
_oracle(
    "partition_rowcount",
    TICKS,
    BARS,
    BOTH,
    select="""SELECT dataset, schema_, year(trade_date) AS year,
  month(trade_date) AS month,
  CASE schema_ WHEN 'trades' THEN day(trade_date) ELSE 0 END AS day,
  count(*) AS n_rows FROM both_rows GROUP BY ALL""",
)
_oracle(
    "empty_requests",
    ALL_REQUESTS,
    select="""SELECT r.dataset, r.symbol, r.schema_, r.range_start, r.range_end
FROM requests r WHERE NOT EXISTS (SELECT 1 FROM both_rows b
  WHERE b.dataset = r.dataset AND b.symbol = r.symbol AND b.schema_ = r.schema_
    AND b.trade_date BETWEEN r.range_start AND r.range_end)""",
)


def _catalog_list(where: str) -> str:
    return f"""SELECT c.*, coalesce(s.size_bytes, 0) AS size_bytes,
  coalesce(i.n_issues, 0) AS n_issues
FROM (SELECT {KEY}, count(*) AS n_ranges, min(range_start) AS first_date,
    max(range_end) AS last_date FROM catalog GROUP BY {KEY}) c
LEFT JOIN (SELECT {KEY}, CAST(sum(n_bytes) AS BIGINT) AS size_bytes FROM ticks
  GROUP BY {KEY}) s USING ({KEY})
LEFT JOIN (SELECT {KEY}, count(*) AS n_issues FROM issues GROUP BY {KEY}) i USING ({KEY})
WHERE {where}"""


_oracle(
    "catalog_list",
    TICKS,
    CATALOG,
    NOTICES,
    select=_catalog_list("dataset = 'GLBX.MDP3'"),
)
_oracle(
    "catalog_filter",
    TICKS,
    CATALOG,
    NOTICES,
    select=_catalog_list("schema_ = 'trades' AND lower(symbol) LIKE 'm%'"),
)

OBSERVED = f"""
tick_days AS (SELECT {KEY}, trade_date AS day FROM ticks),
observed AS (
  SELECT * FROM ({_islands("tick_days", KEY)})
  UNION ALL
  SELECT {KEY}, min(first) AS range_start, max(last) AS range_end FROM (
    SELECT *, month_no - row_number() OVER (PARTITION BY {KEY} ORDER BY month_no) AS run
    FROM (SELECT {KEY}, year(trade_date) * 12 + month(trade_date) AS month_no,
      min(trade_date) AS first, max(trade_date) AS last FROM bars GROUP BY ALL))
  GROUP BY {KEY}, run)"""
STYPE = """CASE WHEN regexp_matches(symbol, '^[A-Z0-9]+\\.[cvn]\\.[0-9]+$')
    THEN 'continuous' WHEN regexp_matches(symbol, '^[A-Z0-9]+\\.(FUT|OPT|SPOT)$')
    THEN 'parent' ELSE 'raw_symbol' END"""

_oracle(
    "catalog_build",
    TICKS,
    BARS,
    OBSERVED,
    select=f"SELECT *, {STYPE} AS stype FROM observed",
)

_oracle(
    "entry_import",
    TICKS,
    CATALOG,
    select=f"SELECT *, {STYPE} AS stype FROM catalog",
)
_oracle(
    "catalog_write",
    TICKS,
    CATALOG,
    f"""
touched AS (SELECT DISTINCT {KEY} FROM tick_calendar WHERE trade_date > snapshot_date),
tick_days AS (SELECT {KEY}, trade_date AS day FROM ticks),
islands AS ({_islands("tick_days", KEY)})""",
    select=f"""SELECT r.*, {STYPE} AS stype FROM (
  SELECT c.* FROM catalog c ANTI JOIN touched USING ({KEY})
  UNION ALL SELECT i.* FROM islands i SEMI JOIN touched USING ({KEY})) r""",
)
ORACLES["catalog_changes"] = ORACLES["catalog_write"]

# --- filters ---------------------------------------------------------------

_oracle(
    "date_window_filter",
    select="""SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS trade_date
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-19'""",
)
_oracle(
    "symbol_prefix_filter",
    FEED,
    select="""SELECT symbol, volume FROM feed_symbols
WHERE lower(left(symbol, 2)) = 'nq'""",
)
_oracle(
    "supported_contracts",
    FEED,
    select="""SELECT s.root, s.year, s.month, count(*) AS n_rows,
  CAST(sum(f.volume) AS BIGINT) AS volume
FROM supported s JOIN feed f USING (symbol) GROUP BY s.root, s.year, s.month""",
)
_oracle(
    "supported_roots",
    FEED,
    select=f"""SELECT symbol FROM feed_symbols
WHERE list_contains({ROOTS}, upper(symbol))""",
)
_oracle(
    "rejected_symbols",
    FEED,
    select="""SELECT symbol FROM feed_symbols
WHERE symbol NOT IN (SELECT symbol FROM supported)""",
)
_oracle(
    "lookahead_flag",
    TICKS,
    select="""SELECT dataset, symbol, count(*) AS n_rows,
  regexp_matches(symbol, '\\.[vn]\\.') AS has_lookahead
FROM ticks GROUP BY dataset, symbol""",
)

BAR_YEARS = """
bar_years AS (SELECT root, min(year(trade_date)) AS from_year,
  max(year(trade_date)) AS to_year FROM bars GROUP BY root)"""

_oracle(
    "available_contracts",
    CALENDAR,
    BARS,
    CONTRACTS,
    BAR_YEARS,
    select="""SELECT root, symbol, window_start,
  least(expiration, DATE '2021-05-31') AS window_end, expiration
FROM quarters JOIN bar_years USING (root)
WHERE year BETWEEN from_year AND to_year AND window_start <= DATE '2021-05-31'""",
)

# --- calendar --------------------------------------------------------------


def _utc(day: str, clock: str, calendar: str, part: str) -> str:
    """Hour or minute in UTC of local minutes after midnight of a day."""
    standard = f"CASE {calendar} WHEN 'CMES' THEN 360 ELSE 300 END"
    # Offsets never change between a session's clock times and 02:00.
    saving = (
        f"CASE WHEN EXISTS (SELECT 1 FROM daylight l WHERE {day} >= l.first "
        f"AND {day} < l.last) THEN 60 ELSE 0 END"
    )
    minutes = f"({clock} + {standard} - {saving})"
    value = f"({minutes} // 60) % 24" if part == "hour" else f"{minutes} % 60"
    return f"CAST({value} AS BIGINT)"


OPEN_CLOCK = "(CASE c.calendar WHEN 'CMES' THEN 1020 WHEN 'IEPA' THEN 1200 ELSE 570 END)"
CLOSE_CLOCK = """(CASE c.calendar
    WHEN 'CMES' THEN CASE WHEN c.is_early_close THEN 720 ELSE 1020 END
    WHEN 'IEPA' THEN CASE WHEN c.is_early_close THEN 780 ELSE 1080 END
    ELSE CASE WHEN c.is_early_close THEN 780 ELSE 960 END END)"""
OPEN_DAY = "(CASE c.calendar WHEN 'XNYS' THEN c.day ELSE c.day - 1 END)"


def _if_session(value: str) -> str:
    return f"CASE WHEN c.is_session THEN {value} END"


_oracle(
    "calendar_dim",
    CALENDAR,
    BARS,
    select=f"""SELECT c.calendar, c.day, c.is_session,
  c.is_session AND c.is_early_close AS is_early_close, b.n_rows,
  {_if_session(_utc(OPEN_DAY, OPEN_CLOCK, "c.calendar", "hour"))} AS open_hour,
  {_if_session(_utc(OPEN_DAY, OPEN_CLOCK, "c.calendar", "minute"))} AS open_minute,
  {_if_session(_utc("c.day", CLOSE_CLOCK, "c.calendar", "hour"))} AS close_hour,
  {_if_session(_utc("c.day", CLOSE_CLOCK, "c.calendar", "minute"))} AS close_minute
FROM cal c JOIN (SELECT trade_date AS day, count(*) AS n_rows FROM bars GROUP BY 1) b
  USING (day)""",
)
_oracle(
    "calendar_lookup",
    TICKS,
    select="""SELECT dataset, calendar, count(*) AS n_rows FROM tick_calendar
GROUP BY dataset, calendar""",
)
_oracle(
    "session_enrich",
    CALENDAR,
    TICKS,
    select="""SELECT t.event_id, t.dataset, t.trade_date, t.calendar, c.is_session,
  c.is_session AND c.is_early_close AS is_early_close
FROM tick_calendar t JOIN cal c ON c.calendar = t.calendar AND c.day = t.trade_date""",
)

DATASET_DAYS = """
dataset_days AS (SELECT dataset, CASE dataset WHEN 'GLBX.MDP3' THEN 'CMES'
    WHEN 'IFUS.IMPACT' THEN 'IEPA' ELSE 'XNYS' END AS calendar, trade_date,
  count(*) AS n_rows FROM both_rows GROUP BY dataset, trade_date)"""

_oracle(
    "session_close",
    CALENDAR,
    TICKS,
    BARS,
    BOTH,
    DATASET_DAYS,
    select=f"""SELECT d.dataset, d.trade_date, d.n_rows,
  {_if_session(_utc("c.day", CLOSE_CLOCK, "c.calendar", "hour"))} AS close_hour,
  {_if_session(_utc("c.day", CLOSE_CLOCK, "c.calendar", "minute"))} AS close_minute
FROM dataset_days d JOIN cal c ON c.calendar = d.calendar AND c.day = d.trade_date""",
)
_oracle(
    "prev_next_session",
    CALENDAR,
    TICKS,
    BARS,
    BOTH,
    DATASET_DAYS,
    select="""SELECT d.dataset, d.trade_date, d.n_rows, d.calendar,
  max(c.day) FILTER (WHERE c.day <= d.trade_date) AS prev_session,
  min(c.day) FILTER (WHERE c.day >= d.trade_date) AS next_session
FROM dataset_days d JOIN cal c ON c.calendar = d.calendar AND c.is_session
  AND c.day BETWEEN d.trade_date - 10 AND d.trade_date + 10
GROUP BY d.dataset, d.trade_date, d.n_rows, d.calendar""",
)
_oracle(
    "trading_days",
    CALENDAR,
    TICKS,
    TICK_REQUESTS,
    select="""SELECT r.dataset, r.symbol, r.range_start, r.range_end,
  c.day AS trade_date
FROM tick_requests r JOIN cal c
  ON c.calendar = CASE r.dataset WHEN 'GLBX.MDP3' THEN 'CMES' ELSE 'XNYS' END
 AND c.is_session AND c.day BETWEEN r.range_start AND r.range_end""",
)
_oracle(
    "trading_day_count",
    CALENDAR,
    BARS,
    RECORDED_DAYS,
    select="""SELECT dataset, symbol, range_start, range_end,
  (SELECT count(*) FROM cal c WHERE c.is_session AND c.calendar =
    CASE dataset WHEN 'GLBX.MDP3' THEN 'CMES' ELSE 'IEPA' END AND c.day BETWEEN range_start AND range_end) AS trading_days
FROM recorded""",
)

# --- contracts and symbols -------------------------------------------------

_oracle(
    "quarterly_contracts",
    CALENDAR,
    BARS,
    CONTRACTS,
    BAR_YEARS,
    select="""SELECT root, year, month, symbol FROM quarters JOIN bar_years USING (root)
WHERE year BETWEEN from_year AND to_year""",
)
_oracle(
    "contract_expirations",
    CALENDAR,
    BARS,
    CONTRACTS,
    BAR_YEARS,
    select="""SELECT e.root, e.symbol, e.rule, e.year, e.month, e.expiration,
  (SELECT count(*) FROM bars b WHERE b.root = e.root AND b.trade_date = e.expiration)
    AS n_rows
FROM expiry e JOIN bar_years y USING (root) WHERE e.year BETWEEN from_year AND to_year""",
)
_oracle(
    "contract_windows",
    CALENDAR,
    BARS,
    CONTRACTS,
    BAR_YEARS,
    select="""SELECT root, symbol, previous_symbol, window_start, expiration
FROM quarters JOIN bar_years USING (root) WHERE year BETWEEN from_year AND to_year""",
)
_oracle(
    "contract_slice",
    HOLDINGS,
    select="""SELECT root, symbol, count(*) AS n_rows,
  CAST(sum(volume) AS BIGINT) AS volume, min(trade_date) AS first_date,
  max(trade_date) AS last_date
FROM sliced GROUP BY root, symbol""",
)
_oracle(
    "front_month_asof",
    CALENDAR,
    BARS,
    CONTRACTS,
    select="""SELECT b.root, b.day, b.n_rows, q.symbol AS front_symbol, q.window_start,
  q.expiration, least(q.expiration, DATE '2021-12-30') AS window_end
FROM (SELECT root, trade_date AS day, count(*) AS n_rows FROM bars GROUP BY 1, 2) b
ASOF JOIN quarters q ON q.root = b.root AND q.expiration >= b.day""",
)
_oracle(
    "symbol_parse",
    FEED,
    select=f"""SELECT f.symbol, f.volume, p.root, p.year, p.month,
  p.root || substr({LETTERS}, CAST(p.month AS INTEGER), 1) || CAST(p.year % 10 AS VARCHAR)
    AS vendor_symbol
FROM feed_symbols f LEFT JOIN parsed p USING (symbol)""",
)
_oracle(
    "symbol_type",
    FEED,
    select=f"""SELECT symbol, volume, {STYPE} AS stype,
  replace(symbol, '.', '_') AS path_name, replace(symbol, '_', '.') AS restored
FROM feed_symbols""",
)
_oracle(
    "symbol_canonical",
    FEED,
    select="""SELECT CASE WHEN contains(symbol, '.')
    THEN upper(split_part(symbol, '.', 1)) || substr(symbol, strpos(symbol, '.'))
    ELSE upper(symbol) END AS canonical,
  CAST(sum(volume) AS BIGINT) AS volume, count(DISTINCT symbol) AS n_spellings
FROM feed GROUP BY 1""",
)
NEXT_SYMBOL = """root || CASE WHEN month >= 12 OR month < 3 THEN 'H'
    WHEN month < 6 THEN 'M' WHEN month < 9 THEN 'U' ELSE 'Z' END
    || lpad(CAST((CASE WHEN month = 12 THEN year + 1 ELSE year END) % 100 AS VARCHAR),
      2, '0')"""

_oracle(
    "symbol_master",
    FEED,
    select=f"""SELECT f.symbol, {STYPE} AS stype, CASE WHEN contains(symbol, '.')
    THEN upper(split_part(symbol, '.', 1)) || substr(symbol, strpos(symbol, '.'))
    ELSE upper(symbol) END AS canonical, replace(symbol, '.', '_') AS path_name,
  regexp_matches(symbol, '\\.[vn]\\.') AS has_lookahead,
  coalesce(list_contains({ROOTS}, root), false) AS is_supported, root, year, month,
  root || substr({LETTERS}, CAST(month AS INTEGER), 1) || CAST(year % 10 AS VARCHAR)
    AS vendor_symbol, {NEXT_SYMBOL} AS next_symbol
FROM feed_symbols f LEFT JOIN parsed p USING (symbol)""",
)
_oracle(
    "next_contract",
    FEED,
    select=f"""SELECT symbol, volume,
  {NEXT_SYMBOL} AS next_symbol,
  root || CASE WHEN month <= 3 THEN 'Z' WHEN month <= 6 THEN 'H' WHEN month <= 9 THEN 'M'
    ELSE 'U' END
    || lpad(CAST((CASE WHEN month <= 3 THEN year - 1 ELSE year END) % 100 AS VARCHAR),
      2, '0') AS previous_symbol
FROM supported""",
)

# --- intervals -------------------------------------------------------------

_oracle("merge_ranges", BARS, RECORDED_DAYS, select=_islands("recorded_days", KEY))

REQUEST_KEY = f"{KEY}, request_start, request_end"
REQUEST_DAYS = """
request_days AS (SELECT dataset, symbol, schema_, range_start AS request_start,
  range_end AS request_end,
  CAST(unnest(generate_series(range_start, range_end, INTERVAL 1 DAY)) AS DATE) AS day
  FROM {requests})"""

_oracle(
    "missing_ranges",
    BARS,
    RECORDED_DAYS,
    BAR_REQUESTS,
    REQUEST_DAYS.format(requests="bar_requests"),
    """
gap_days AS (SELECT r.* FROM request_days r ANTI JOIN recorded_days d
  USING (dataset, symbol, schema_, day))""",
    select=_islands("gap_days", REQUEST_KEY),
)
_oracle(
    "subtract_range",
    BARS,
    RECORDED_DAYS,
    """
cleared_days AS (SELECT DISTINCT dataset, symbol, schema_, CAST(unnest(generate_series(
    trade_date, trade_date + CAST(line AS INTEGER), INTERVAL 1 DAY)) AS DATE) AS day
  FROM bars WHERE is_returned),
left_days AS (SELECT d.* FROM recorded_days d ANTI JOIN cleared_days c
  USING (dataset, symbol, schema_, day))""",
    select=_islands("left_days", KEY),
)
_oracle(
    "missing_union",
    ALL_REQUESTS,
    RECORDED_DAYS,
    CATALOG,
    REQUEST_DAYS.format(requests="requests"),
    """
known_days AS (SELECT * FROM recorded_days UNION
  SELECT dataset, symbol, schema_, CAST(unnest(generate_series(range_start, range_end,
    INTERVAL 1 DAY)) AS DATE) FROM catalog),
gap_days AS (
  SELECT r.* FROM request_days r ANTI JOIN known_days d
    USING (dataset, symbol, schema_, day)
  UNION
  SELECT dataset, symbol, schema_, range_start, range_end, CAST(unnest(generate_series(
    part_start, part_end, INTERVAL 1 DAY)) AS DATE) FROM missing)""",
    select=_islands("gap_days", REQUEST_KEY),
)
_oracle(
    "month_reload_window",
    BARS,
    RECORDED_DAYS,
    """
inner_requests AS (SELECT * FROM (SELECT dataset, symbol, schema_,
    min(trade_date) + 45 AS range_start, max(trade_date) - 40 AS range_end
  FROM bars GROUP BY dataset, symbol, schema_) WHERE range_start <= range_end)""",
    REQUEST_DAYS.format(requests="inner_requests"),
    """
asked AS (SELECT r.*, d.day IS NULL AS is_gap FROM request_days r
  LEFT JOIN recorded_days d USING (dataset, symbol, schema_, day)),
reload AS (SELECT dataset, symbol, schema_, year(day) AS year, month(day) AS month
  FROM asked GROUP BY ALL HAVING bool_or(is_gap)),
all_days AS (SELECT dataset, symbol, schema_, day FROM request_days UNION
  SELECT dataset, symbol, schema_, day FROM recorded_days)""",
    select=f"""SELECT {KEY}, CAST(l.year AS BIGINT) AS year,
  CAST(l.month AS BIGINT) AS month, min(a.day) AS load_start, max(a.day) AS load_end
FROM reload l JOIN all_days a USING ({KEY})
WHERE year(a.day) = l.year AND month(a.day) = l.month
GROUP BY {KEY}, l.year, l.month""",
)
_oracle("observed_islands", TICKS, BARS, OBSERVED, select="SELECT * FROM observed")
_oracle(
    "session_islands",
    CALENDAR,
    TICKS,
    f"""
seen AS (SELECT DISTINCT {KEY}, calendar, trade_date AS day FROM tick_calendar),
steps AS (SELECT *, lag(day) OVER (PARTITION BY {KEY} ORDER BY day) AS before FROM seen),
marked AS (SELECT s.*, CASE WHEN s.before IS NULL OR EXISTS (SELECT 1 FROM cal c
    WHERE c.calendar = s.calendar AND c.is_session AND c.day > s.before
      AND c.day < s.day) THEN 1 ELSE 0 END AS opens FROM steps s),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY {KEY} ORDER BY day) AS island
  FROM marked)""",
    select=f"""SELECT {KEY}, min(day) AS range_start, max(day) AS range_end,
  count(*) AS days FROM numbered GROUP BY {KEY}, island""",
)
_oracle(
    "delete_window",
    TICKS,
    TICK_REQUESTS,
    """
marked AS (SELECT t.*, EXISTS (SELECT 1 FROM tick_requests r
      WHERE r.dataset = t.dataset AND r.symbol = t.symbol
        AND t.trade_date BETWEEN r.range_start AND r.range_end)
    OR (t.dataset = 'UNKNOWN.DATASET'
      AND t.trade_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12') AS is_deleted
  FROM ticks t)""",
    select=f"""SELECT {KEY},
  count(DISTINCT trade_date) FILTER (WHERE is_deleted) AS n_deleted_partitions,
  count(*) FILTER (WHERE is_deleted) AS n_deleted_rows,
  count(*) FILTER (WHERE NOT is_deleted) AS n_left_rows,
  CAST(coalesce(sum(price_cents) FILTER (WHERE NOT is_deleted), 0) AS BIGINT)
    AS left_cents
FROM marked GROUP BY {KEY}""",
)

# --- coverage --------------------------------------------------------------

PARTITION_ROWS = f"{KEY}, range_start, range_end, {PARTITION}, part_start, part_end"

_oracle(
    "expected_partitions", ALL_REQUESTS, select=f"SELECT {PARTITION_ROWS} FROM expected"
)
_oracle(
    "missing_partitions", ALL_REQUESTS, select=f"SELECT {PARTITION_ROWS} FROM missing"
)

STATUS = f"""
counted AS (SELECT r.*, coalesce(e.n, 0) AS total_partitions, coalesce(m.n, 0)
    AS missing_partitions
  FROM requests r
  LEFT JOIN (SELECT {KEY}, range_start, range_end, count(*) AS n FROM expected
    GROUP BY ALL) e USING ({KEY}, range_start, range_end)
  LEFT JOIN (SELECT {KEY}, range_start, range_end, count(*) AS n FROM missing
    GROUP BY ALL) m USING ({KEY}, range_start, range_end)),
status AS (SELECT *, total_partitions - missing_partitions AS cached_partitions,
    CASE WHEN missing_partitions = 0 THEN 'COMPLETE'
      WHEN missing_partitions = total_partitions THEN 'EMPTY' ELSE 'PARTIAL' END AS status
  FROM counted)"""

KNOWN_DAYS = """
known_days AS (SELECT * FROM recorded_days UNION
  SELECT dataset, symbol, schema_, CAST(unnest(generate_series(range_start, range_end,
    INTERVAL 1 DAY)) AS DATE) FROM catalog)"""
# Partitions of which a requested day is not recorded, or that have no rows.
KNOWN_PARTS = f"""
known_parts AS (SELECT {", ".join("e." + k for k in KEY.split(", "))}, e.range_start,
    e.range_end, e.year, e.month, e.day, count(*) AS n
  FROM expected e JOIN known_days k ON k.dataset = e.dataset AND k.symbol = e.symbol
    AND k.schema_ = e.schema_ AND k.day BETWEEN e.part_start AND e.part_end
  GROUP BY ALL),
unknown_parts AS (SELECT e.* FROM expected e LEFT JOIN known_parts k
    USING ({KEY}, range_start, range_end, year, month, day)
  WHERE coalesce(k.n, 0) < e.part_end - e.part_start + 1)"""
LACKING = f"""{KNOWN_PARTS},
lacking AS (SELECT * FROM missing UNION SELECT * FROM unknown_parts)"""
FULL_STATUS = STATUS.replace("FROM missing", "FROM lacking")

_oracle(
    "coverage_status",
    ALL_REQUESTS,
    RECORDED_DAYS,
    CATALOG,
    KNOWN_DAYS,
    LACKING,
    FULL_STATUS,
    select="SELECT * FROM status",
)
_oracle(
    "coverage_status_catalog",
    ALL_REQUESTS,
    RECORDED_DAYS,
    CATALOG,
    KNOWN_DAYS,
    KNOWN_PARTS,
    STATUS.replace("FROM missing", "FROM unknown_parts"),
    select="SELECT * FROM status",
)
_oracle(
    "observed_range",
    TICKS,
    BARS,
    BOTH,
    select=f"""SELECT {KEY}, min(trade_date) AS first_date, max(trade_date) AS last_date
FROM both_rows GROUP BY {KEY}""",
)
_oracle(
    "observed_range_files",
    TICKS,
    select=f"""SELECT {MINUTE_KEY}, year(trade_date) AS year, month(trade_date) AS month,
  0 AS day, min(trade_date) AS first_date, max(trade_date) AS last_date
FROM ticks GROUP BY ALL""",
)

_oracle(
    "served_read",
    CALENDAR,
    TICKS,
    "both_rows AS (SELECT * FROM ticks)",
    TICK_REQUESTS,
    "bar_requests AS (SELECT * FROM tick_requests WHERE false)",
    EXPECTED,
    CATALOG,
    f"""
known_days AS (SELECT {KEY}, CAST(unnest(generate_series(range_start, range_end,
    INTERVAL 1 DAY)) AS DATE) AS day FROM catalog)""",
    LACKING,
    FULL_STATUS,
    select=f"""SELECT event_id, {KEY}, trade_date, price_cents FROM ticks t
WHERE EXISTS (SELECT 1 FROM status s WHERE s.status = 'COMPLETE'
  AND s.dataset = t.dataset AND s.symbol = t.symbol
  AND t.trade_date BETWEEN s.range_start AND s.range_end)""",
)

# --- inventory -------------------------------------------------------------

_oracle(
    "inventory_groups",
    HOLDINGS,
    select="""SELECT *, n_quarterly < expected_quarterly AS has_gaps FROM held_groups""",
)
_oracle(
    "inventory_listing",
    TICKS,
    """
items AS (SELECT dataset, symbol, schema_, contains(symbol, '.') AS alone,
    left(symbol, length(symbol) - 3) AS root,
    CASE symbol[-3] WHEN 'H' THEN 1 WHEN 'M' THEN 2 WHEN 'U' THEN 3 ELSE 4 END AS quarter,
    CAST(sum(n_bytes) AS BIGINT) AS size_bytes,
    count(*) FILTER (WHERE price_cents < 100) AS n_issues
  FROM ticks GROUP BY ALL)""",
    select="""SELECT 'group' AS kind, dataset, root, schema_, count(*) AS n_contracts,
  arg_min(symbol, quarter) AS first_symbol, arg_max(symbol, quarter) AS last_symbol,
  CAST(sum(size_bytes) AS BIGINT) AS size_bytes, CAST(sum(n_issues) AS BIGINT) AS n_issues,
  count(*) AS n_quarterly, CAST(max(quarter) - min(quarter) + 1 AS BIGINT) AS expected_quarterly,
  count(*) < max(quarter) - min(quarter) + 1 AS has_gaps
FROM items WHERE NOT alone GROUP BY dataset, root, schema_
UNION ALL
SELECT 'single', dataset, NULL, schema_, 0, symbol, symbol, size_bytes, n_issues, 0, 0, false
FROM items WHERE alone""",
)
_oracle(
    "contract_chain_gaps",
    HOLDINGS,
    select="""SELECT book, dataset, root, schema_, first_symbol, last_symbol,
  expected_quarterly - n_quarterly AS n_absent FROM held_groups
WHERE n_quarterly < expected_quarterly""",
)
_oracle(
    "inventory_totals",
    HOLDINGS,
    select="""SELECT count(*) AS n_items, CAST(sum(size_bytes) AS BIGINT) AS size_bytes
FROM holdings""",
)
_oracle(
    "inventory_order",
    HOLDINGS,
    TICKS,
    f"""
listed AS (SELECT dataset, symbol, schema_ FROM ticks
  UNION SELECT dataset, symbol, schema_ FROM holdings),
keyed AS (SELECT *,
    regexp_matches(symbol, '^[A-Z0-9]{{1,4}}[FGHJKMNQUVXZ][0-9]{{2}}$')
      AND list_contains({ROOTS}, left(symbol, length(symbol) - 3)) AS is_contract,
    regexp_matches(symbol, '\\.[cvn]\\.') AS is_rolling FROM listed)""",
    select=f"""SELECT dataset, symbol, schema_, row_number() OVER (PARTITION BY dataset
  ORDER BY CASE WHEN is_contract THEN left(symbol, length(symbol) - 3)
      WHEN is_rolling THEN split_part(symbol, '.', 1) ELSE symbol END,
    CASE WHEN is_contract THEN 1 WHEN is_rolling THEN 0 ELSE 2 END,
    CASE WHEN is_contract THEN right(symbol, 2) ELSE '' END,
    CASE WHEN is_contract THEN strpos({LETTERS}, substr(symbol, length(symbol) - 2, 1))
      ELSE 0 END,
    CASE schema_ WHEN 'ohlcv-1d' THEN 0 WHEN 'ohlcv-1h' THEN 1 WHEN 'ohlcv-1m' THEN 2
      WHEN 'ohlcv-1s' THEN 3 ELSE 99 END, schema_, symbol) AS position
FROM keyed""",
)

# --- quality ---------------------------------------------------------------

_oracle(
    "quality_extract",
    ISSUES,
    select=f"SELECT {KEY}, issue_date, issue_type, message, arrival FROM issues",
)
_oracle(
    "quality_merge",
    ISSUES,
    """
merged AS (SELECT * FROM issues_all QUALIFY row_number() OVER (
    PARTITION BY dataset, symbol, schema_, issue_date
    ORDER BY trade_date >= DATE '2024-01-16', arrival, place) = 1)""",
    select=f"SELECT {KEY}, issue_date, issue_type, arrival FROM merged",
)
_oracle(
    "quality_filter",
    ISSUES,
    select=f"""SELECT {KEY}, issue_date, issue_type FROM issues
WHERE issue_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
  AND symbol ILIKE 'n%' AND schema_ = 'trades'""",
)
_oracle(
    "quality_counts",
    ISSUES,
    select=f"SELECT {KEY}, count(*) AS n_issues FROM issues GROUP BY {KEY}",
)
_oracle(
    "quality_digest",
    ISSUES,
    select=f"""SELECT {KEY}, count(*) AS n_issues,
  array_to_string(list_slice(list(CAST(issue_date AS VARCHAR) ORDER BY issue_date), 1, 3),
    ', ') || CASE WHEN count(*) > 3 THEN ' (+' || (count(*) - 3) || ' more)' ELSE '' END
    AS digest
FROM issues GROUP BY {KEY}""",
)

# --- catalog upkeep --------------------------------------------------------

_oracle(
    "orphan_partitions",
    TICKS,
    CATALOG,
    select=f"""SELECT DISTINCT {KEY}, CAST(year(trade_date) AS BIGINT) AS year,
  CAST(month(trade_date) AS BIGINT) AS month, CAST(day(trade_date) AS BIGINT) AS day
FROM ticks t WHERE NOT EXISTS (SELECT 1 FROM catalog c
  WHERE c.dataset = t.dataset AND c.symbol = t.symbol)""",
)

FINDINGS = f"""
actual AS (SELECT {KEY}, min(trade_date) AS first_date, max(trade_date) AS last_date
  FROM ticks GROUP BY {KEY}),
recorded_keys AS (SELECT {KEY}, min(range_start) AS recorded_start,
    max(range_end) AS recorded_end, count(*) AS n FROM catalog GROUP BY {KEY}),
findings AS (SELECT {KEY}, recorded_start, recorded_end,
    coalesce(n, 0) AS recorded_ranges, first_date, last_date,
    CASE WHEN n IS NULL THEN 'orphan' WHEN first_date IS NULL THEN 'no_rows'
      WHEN n = 1 AND recorded_start = first_date AND recorded_end = last_date THEN 'ok'
      ELSE 'mismatch' END AS finding
  FROM recorded_keys FULL JOIN actual USING ({KEY}))"""

_oracle("catalog_validate", TICKS, CATALOG, FINDINGS, select="SELECT * FROM findings")
_oracle(
    "catalog_validate_files",
    TICKS,
    CATALOG,
    FINDINGS,
    select="SELECT * REPLACE ('ohlcv-1m' AS schema_) FROM findings",
)
_oracle(
    "catalog_fix",
    TICKS,
    CATALOG,
    FINDINGS,
    f"""
tick_days AS (SELECT {KEY}, trade_date AS day FROM ticks),
islands AS ({_islands("tick_days", KEY)})""",
    select=f"""SELECT r.*, {STYPE} AS stype FROM (
  SELECT c.* FROM catalog c SEMI JOIN (SELECT * FROM findings
    WHERE finding IN ('ok', 'no_rows')) f USING ({KEY})
  UNION ALL
  SELECT i.* FROM islands i SEMI JOIN (SELECT * FROM findings
    WHERE finding IN ('mismatch', 'orphan')) f USING ({KEY})) r""",
)
_oracle(
    "catalog_rebuild",
    TICKS,
    CATALOG,
    FINDINGS,
    select=f"""SELECT {KEY}, {STYPE} AS stype, first_date AS range_start,
  last_date AS range_end FROM findings WHERE finding = 'orphan'""",
)
_oracle(
    "verify_report",
    CALENDAR,
    TICKS,
    BARS,
    BOTH,
    f"""
spans AS (SELECT {KEY}, min(trade_date) AS range_start, max(trade_date) AS range_end
  FROM both_rows GROUP BY {KEY}),
tick_requests AS (SELECT * FROM spans WHERE schema_ = 'trades'),
bar_requests AS (SELECT * FROM spans WHERE schema_ <> 'trades')""",
    EXPECTED,
    STATUS,
    select="SELECT * FROM status WHERE status <> 'COMPLETE'",
)

# --- plans -----------------------------------------------------------------

_oracle(
    "dataset_available_end",
    TICKS,
    BARS,
    BOTH,
    select="""SELECT dataset, max(trade_date) AS available_end FROM both_rows
GROUP BY dataset""",
)


def _plan(source: str, keys: str, as_of: str, rows: str) -> str:
    return f"""
plan AS (
  SELECT {keys}, last_date, expiration,
    CASE WHEN due THEN last_date + 1 END AS range_start,
    CASE WHEN due THEN until END AS range_end,
    CASE WHEN due THEN 'due' ELSE 'up_to_date' END AS state
  FROM (SELECT *, last_date + 1 <= until
      AND (expiration IS NULL OR last_date < expiration) AS due
    FROM (SELECT l.*, q.expiration, least(DATE '{as_of}' - 1, a.available_end,
        coalesce(q.expiration, DATE '9999-12-31')) AS until
      FROM (SELECT {keys}, max(range_end) AS last_date FROM {source} GROUP BY {keys}) l
      JOIN (SELECT dataset, max(trade_date) AS available_end FROM {rows} GROUP BY 1) a
        USING (dataset)
      LEFT JOIN expiry q USING (symbol))))"""


HOLDING = "book, dataset, symbol, schema_"
SERIES_PLAN = _plan("catalog", KEY, "2024-02-01", "ticks")

_oracle(
    "update_plan",
    HOLDINGS,
    _plan("holdings", HOLDING, "2021-12-31", "bars"),
    select="SELECT * FROM plan",
)
_oracle(
    "update_plan_series",
    CALENDAR,
    TICKS,
    CONTRACTS,
    CATALOG,
    SERIES_PLAN,
    select="SELECT * FROM plan",
)
_oracle(
    "update_plan_summary",
    CALENDAR,
    TICKS,
    CONTRACTS,
    CATALOG,
    SERIES_PLAN,
    select=f"""SELECT outcome, count(*) AS n_items FROM (
  SELECT CASE WHEN p.state = 'up_to_date' THEN 'up_to_date'
    WHEN EXISTS (SELECT 1 FROM ticks t WHERE t.dataset = p.dataset
      AND t.symbol = p.symbol AND t.trade_date BETWEEN p.range_start AND p.range_end)
    THEN 'updated' ELSE 'error' END AS outcome FROM plan p) GROUP BY outcome""",
)
_oracle(
    "auto_roll_plan",
    HOLDINGS,
    select="""SELECT f.book, f.dataset, f.symbol, string_agg(f.schema_, ',' ORDER BY
    f.schema_) AS schemas, q.window_start AS range_start,
  least(q.expiration, DATE '2021-12-30') AS range_end
FROM (SELECT h.book, h.dataset, o.next_symbol AS symbol, h.schema_
  FROM holdings h JOIN quarters o USING (symbol) WHERE h.range_end >= o.expiration) f
ANTI JOIN holdings n USING (book, dataset, symbol, schema_)
JOIN quarters q ON q.symbol = f.symbol
WHERE q.window_start <= DATE '2021-12-30'
GROUP BY f.book, f.dataset, f.symbol, q.window_start, q.expiration""",
)
_oracle(
    "batch_plan",
    HOLDINGS,
    """
spans AS (SELECT book, dataset, root, feed AS schema_,
    min(year(trade_date)) AS from_year, max(year(trade_date)) AS to_year
  FROM sliced GROUP BY ALL),
wanted AS (SELECT s.book, s.dataset, s.root, q.symbol, s.schema_,
    q.window_start AS range_start, least(q.expiration, DATE '2021-12-30') AS range_end
  FROM spans s JOIN quarters q ON q.root = s.root
    AND q.year BETWEEN s.from_year AND s.to_year
    AND q.window_start <= DATE '2021-12-30'),
wanted_months AS (SELECT w.*, unnest(range(
    year(range_start) * 12 + month(range_start),
    year(range_end) * 12 + month(range_end) + 1)) AS month_no FROM wanted w),
row_months AS (SELECT DISTINCT book, dataset, root, symbol, feed AS schema_,
    year(trade_date) * 12 + month(trade_date) AS month_no FROM sliced),
held_months AS (SELECT w.* EXCLUDE (range_start, range_end) FROM (SELECT *,
      make_date((month_no - 1) // 12, (month_no - 1) % 12 + 1, 1) AS first
    FROM wanted_months) w
  JOIN row_months USING (book, dataset, root, symbol, schema_, month_no)
  JOIN holdings h USING (book, dataset, symbol, schema_)
  WHERE h.range_start <= greatest(w.first, w.range_start)
    AND h.range_end >= least(last_day(w.first), w.range_end)),
counted AS (SELECT w.book, w.dataset, w.root, w.symbol, w.schema_, w.range_start,
    w.range_end, count(*) AS total_partitions, count(h.month_no) AS cached_partitions
  FROM wanted_months w LEFT JOIN held_months h
    USING (book, dataset, root, symbol, schema_, month_no) GROUP BY ALL)""",
    select="""SELECT *, total_partitions - cached_partitions AS missing_partitions,
  CASE WHEN total_partitions = cached_partitions THEN 'COMPLETE'
    WHEN cached_partitions = 0 THEN 'EMPTY' ELSE 'PARTIAL' END AS status,
  CASE WHEN total_partitions = cached_partitions THEN 'skip' ELSE 'load' END AS action
FROM counted""",
)
_oracle(
    "ensure_split",
    ALL_REQUESTS,
    RECORDED_DAYS,
    CATALOG,
    KNOWN_DAYS,
    LACKING,
    FULL_STATUS,
    f"""
absent_days AS (SELECT {KEY}, range_start AS request_start, range_end AS request_end,
    CAST(unnest(generate_series(part_start, part_end, INTERVAL 1 DAY)) AS DATE) AS day
  FROM missing),
lacking_days AS (SELECT {KEY}, range_start AS request_start, range_end AS request_end,
    CAST(unnest(generate_series(part_start, part_end, INTERVAL 1 DAY)) AS DATE) AS day
  FROM lacking),
gap_days AS (SELECT * FROM absent_days UNION
  SELECT l.* FROM lacking_days l ANTI JOIN known_days USING ({KEY}, day)),
gaps AS ({_islands("gap_days", REQUEST_KEY)})""",
    select=f"""SELECT {", ".join("s." + k for k in KEY.split(", "))},
  s.range_start AS request_start, s.range_end AS request_end,
  CASE s.status WHEN 'COMPLETE' THEN 'serve' ELSE 'load' END AS action,
  g.range_start AS gap_start, g.range_end AS gap_end
FROM status s LEFT JOIN gaps g ON g.dataset = s.dataset AND g.symbol = s.symbol
  AND g.schema_ = s.schema_ AND g.request_start = s.range_start
  AND g.request_end = s.range_end""",
)
_oracle(
    "incremental_load",
    CALENDAR,
    TICKS,
    select=f"""SELECT {TICK_FOLDER}, count(*) AS n_rows,
  CAST(sum(price_cents) AS BIGINT) AS price_cents
FROM tick_calendar t JOIN cal c ON c.calendar = t.calendar AND c.day = t.trade_date
WHERE t.trade_date <= t.snapshot_date
  OR (c.is_session AND t.trade_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31')
GROUP BY ALL""".replace("SELECT dataset", "SELECT t.dataset"),
)
_oracle(
    "stream_ingest",
    TICKS,
    select=f"SELECT {TICK_FOLDER}, count(*) AS n_rows FROM ticks GROUP BY ALL",
)

# --- load jobs -------------------------------------------------------------

# A tick stays or arrives: loaded before the snapshot, or on a January session.
STORE = f"""
loaded_rows AS (SELECT t.* EXCLUDE (calendar), t.trade_date <= t.snapshot_date AS was_there
  FROM tick_calendar t JOIN cal c ON c.calendar = t.calendar AND c.day = t.trade_date
  WHERE t.trade_date <= t.snapshot_date
    OR (c.is_session AND t.trade_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31')),
catalog_days AS (SELECT {KEY}, CAST(unnest(generate_series(range_start, range_end,
    INTERVAL 1 DAY)) AS DATE) AS day FROM catalog),
store_days AS (SELECT * FROM catalog_days UNION
  SELECT {KEY}, trade_date FROM loaded_rows WHERE NOT was_there)"""


def _store(rows: str, days: str, extra: str = "") -> str:
    return f"""SELECT {KEY}, coalesce(n_rows, 0) AS n_rows,
  CAST(coalesce(price_cents, 0) AS BIGINT) AS price_cents,
  coalesce(n_recorded_days, 0) AS n_recorded_days,
  coalesce(n_partitions, 0) AS n_partitions{extra}
FROM (SELECT {KEY}, count(*) AS n_rows, sum(price_cents) AS price_cents,
    count(DISTINCT trade_date) AS n_partitions FROM {rows} GROUP BY ALL)
FULL JOIN (SELECT {KEY}, count(*) AS n_recorded_days FROM {days} GROUP BY ALL)
  USING ({KEY})"""


_oracle(
    "load_job", CALENDAR, TICKS, CATALOG, STORE, select=_store("loaded_rows", "store_days")
)
_oracle(
    "load_job_again",
    CALENDAR,
    TICKS,
    CATALOG,
    STORE,
    select=_store("loaded_rows", "store_days", ", 0::BIGINT AS n_loaded_again"),
)
_oracle(
    "clear_window",
    CALENDAR,
    TICKS,
    TICK_REQUESTS,
    CATALOG,
    STORE,
    f"""
cleared AS (SELECT {KEY}, CAST(unnest(generate_series(range_start, range_end,
    INTERVAL 1 DAY)) AS DATE) AS day FROM tick_requests),
left_rows AS (SELECT r.* FROM loaded_rows r ANTI JOIN (SELECT {KEY}, day AS trade_date
    FROM cleared) c USING ({KEY}, trade_date) WHERE was_there),
left_days AS (SELECT d.* FROM catalog_days d ANTI JOIN cleared USING ({KEY}, day))""",
    select=_store("left_rows", "left_days"),
)
_oracle(
    "verify_fix",
    CALENDAR,
    TICKS,
    CATALOG,
    f"""
held AS (SELECT DISTINCT {KEY}, trade_date AS day FROM tick_calendar
  WHERE trade_date <= snapshot_date)""",
    select="""SELECT dataset, symbol, schema_, range_start, range_end FROM catalog k
WHERE NOT EXISTS (SELECT 1 FROM cal c
  WHERE c.calendar = CASE k.dataset WHEN 'GLBX.MDP3' THEN 'CMES' ELSE 'XNYS' END
    AND c.is_session AND c.day BETWEEN k.range_start AND k.range_end
    AND NOT EXISTS (SELECT 1 FROM held h WHERE h.dataset = k.dataset
      AND h.symbol = k.symbol AND h.day = c.day))""",
)
_oracle(
    "update_all_run",
    CALENDAR,
    TICKS,
    CONTRACTS,
    CATALOG,
    SERIES_PLAN,
    f"""
arrived AS (SELECT p.dataset, p.symbol, p.schema_, count(*) AS n FROM plan p
  JOIN tick_calendar t ON t.dataset = p.dataset AND t.symbol = p.symbol
    AND t.trade_date BETWEEN p.range_start AND p.range_end
  JOIN cal c ON c.calendar = t.calendar AND c.day = t.trade_date AND c.is_session
  GROUP BY ALL)""",
    select=f"""SELECT {KEY}, CASE WHEN state <> 'due' THEN state WHEN n > 0 THEN 'updated'
    ELSE 'error' END AS outcome, coalesce(n, 0) AS n_rows
FROM plan LEFT JOIN arrived USING ({KEY})""",
)
_oracle(
    "catalog_fix_then_validate",
    TICKS,
    CATALOG,
    FINDINGS,
    select=f"""SELECT {KEY}, coalesce(first_date, recorded_start) AS recorded_start,
  coalesce(last_date, recorded_end) AS recorded_end,
  CASE WHEN first_date IS NULL THEN recorded_ranges ELSE 1 END AS recorded_ranges,
  first_date, last_date,
  CASE WHEN first_date IS NULL THEN 'no_rows' ELSE 'ok' END AS finding
FROM findings""",
)

# Sessions of 1999 to 2100 by rule; Easter by the lunar tables of the computus.
FAR_CONTRACTS = f"""
years AS (SELECT unnest(range(1999, 2101)) AS y),
moons AS (SELECT y, (y % 19) AS g, y // 100 AS c FROM years),
epacts AS (SELECT *, (c - c // 4 - (8 * c + 13) // 25 + 19 * g + 15) % 30 AS h FROM moons),
fulls AS (SELECT *, h - (h // 28) * (1 - (29 // (h + 1)) * ((21 - g) // 11)) AS i FROM epacts),
easters AS MATERIALIZED (SELECT y, i - (y + y // 4 + i + 2 - c + c // 4) % 7 AS l FROM fulls),
good_fridays AS MATERIALIZED (SELECT make_date(y, 3 + (l + 40) // 44, l + 28 - 31 * ((3 + (l + 40) // 44) // 4))
    - 2 AS day FROM easters),
far_days AS MATERIALIZED (SELECT CAST(unnest(generate_series(DATE '1999-09-01', DATE '2099-12-31',
    INTERVAL 1 DAY)) AS DATE) AS day),
far_sessions AS MATERIALIZED (SELECT day, row_number() OVER (PARTITION BY date_trunc('month', day)
    ORDER BY day DESC) AS from_end FROM far_days
  WHERE isodow(day) < 6 AND day NOT IN (SELECT day FROM good_fridays)
    AND strftime(day, '%m%d') NOT IN ('0101', '1225')
    AND NOT (isodow(day) = 1 AND strftime(day, '%m%d') IN ('0102', '1226'))
    AND NOT (isodow(day) = 5 AND strftime(day, '%m%d') = '1224')),
far_expiry AS MATERIALIZED (
  SELECT 'treasury' AS rule, date_trunc('month', day) AS m, day FROM far_sessions
  WHERE from_end = 8
  UNION ALL SELECT 'metals', date_trunc('month', day), day FROM far_sessions
  WHERE from_end = 3
  UNION ALL SELECT 'third_friday', date_trunc('month', f.day), max(s.day)
  FROM far_days f JOIN far_sessions s ON s.day BETWEEN f.day - 6 AND f.day
  WHERE isodow(f.day) = 5 AND day(f.day) BETWEEN 15 AND 21 GROUP BY f.day),
far_roots AS (SELECT root, CASE WHEN root IN {TREASURY} THEN 'treasury'
    WHEN root IN {METALS} THEN 'metals' ELSE 'third_friday' END AS rule
  FROM (SELECT unnest({ROOTS}) AS root)),
far_dim AS MATERIALIZED (SELECT r.root, r.rule, year(e.m) AS year, month(e.m) AS month,
    r.root || substr({LETTERS}, CAST(month(e.m) AS INTEGER), 1)
      || lpad(CAST(year(e.m) % 100 AS VARCHAR), 2, '0') AS symbol, e.day AS expiration,
    p.day - 14 AS window_start, e.m
  FROM far_roots r JOIN far_expiry e USING (rule) JOIN far_expiry p ON p.rule = r.rule
    AND p.m = date_trunc('quarter', e.m) - INTERVAL 1 MONTH
  WHERE year(e.m) >= 2000)"""

_oracle(
    "far_contracts",
    FAR_CONTRACTS,
    f"""
far_feed AS (SELECT {ROOTS}[(l_partkey % 21) + 1]
    || substr({LETTERS}, CAST(l_suppkey % 12 AS INTEGER) + 1, 1)
    || CAST(60 + l_orderkey % 40 AS VARCHAR) AS symbol,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume FROM lineitem GROUP BY 1)""",
    select=f"""SELECT f.symbol, f.volume, rule, year, month, expiration, window_start,
  {NEXT_SYMBOL} AS next_symbol
FROM far_feed f LEFT JOIN far_dim d ON d.symbol = f.symbol""",
)
_oracle(
    "request_resolution",
    FEED,
    FAR_CONTRACTS,
    """
open_requests AS (SELECT symbol, volume,
    CASE WHEN volume % 4 < 2 THEN DATE '2015-01-01' + CAST(volume % 2000 AS INTEGER) END AS a,
    CASE WHEN volume % 2 = 0 THEN DATE '2021-12-31' END AS b
  FROM feed_symbols)""",
    select="""SELECT r.symbol, r.volume,
  CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a
    WHEN a IS NULL AND b IS NULL AND d.window_start <= DATE '2021-12-30'
    THEN d.window_start END AS range_start,
  CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN b
    WHEN a IS NULL AND b IS NULL AND d.window_start <= DATE '2021-12-30'
    THEN least(d.expiration, DATE '2021-12-30') END AS range_end,
  CASE WHEN (a IS NULL) <> (b IS NULL) THEN 'one_bound'
    WHEN a IS NULL AND d.symbol IS NULL THEN 'no_dates'
    WHEN a IS NULL AND d.window_start > DATE '2021-12-30' THEN 'not_begun' END
    AS reject_reason
FROM open_requests r LEFT JOIN far_dim d ON d.symbol = upper(r.symbol)""",
)

# All ticks arrive: what has rows is recorded, and nothing else.
_oracle(
    "stream_into_store",
    TICKS,
    f"tick_days AS (SELECT DISTINCT {KEY}, trade_date FROM ticks)",
    select=_store("ticks", "tick_days"),
)
# A request is complete after the load if every session of it has ticks. Ticks of other
# days are there if they were loaded before the snapshot.
_oracle(
    "ensure_serve",
    CALENDAR,
    TICKS,
    TICK_REQUESTS,
    f"""
open_requests AS (SELECT r.dataset, r.symbol, r.schema_, r.range_start
  FROM tick_requests r JOIN cal c
    ON c.calendar = CASE r.dataset WHEN 'GLBX.MDP3' THEN 'CMES' ELSE 'XNYS' END
   AND c.is_session AND c.day BETWEEN r.range_start AND r.range_end
  WHERE NOT EXISTS (SELECT 1 FROM ticks t WHERE t.dataset = r.dataset
    AND t.symbol = r.symbol AND t.trade_date = c.day))""",
    select=f"""SELECT event_id, t.dataset, t.symbol, t.schema_, trade_date, price_cents
FROM tick_calendar t JOIN tick_requests r ON r.dataset = t.dataset AND r.symbol = t.symbol
  AND t.trade_date BETWEEN r.range_start AND r.range_end
JOIN cal c ON c.calendar = t.calendar AND c.day = t.trade_date
WHERE (t.trade_date <= t.snapshot_date OR c.is_session)
  AND NOT EXISTS (SELECT 1 FROM open_requests o WHERE o.dataset = r.dataset
    AND o.symbol = r.symbol AND o.range_start = r.range_start)""",
)
