"""Column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightmere.functions import calendar, privacy, scalars
from brightmere.functions.sqlfuncs import register_sql_functions
from brightmere.plans.joins import _uuid
from brightmere.plans.registry import query
from brightmere.sources.messages import parse_pair


def stamp_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


@query(
    "parse_ts",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate + INTERVAL 90061 SECOND END AS edited,
              o_orderdate AS day
       FROM orders""",
)
def parse_ts(spark, t):
    """Times from text in two patterns; the text of low orders is no time."""
    later = F.col("o_orderdate") + F.expr("INTERVAL 90061 SECOND")
    texts = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "soon")
        .otherwise(F.date_format(later, "yyyyMMddHHmmss"))
        .alias("edited"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"),
    )
    return texts.select(
        "o_orderkey",
        calendar.parse_timestamp(F.col("edited")).cast("timestamp_ntz").alias("edited"),
        calendar.parse_timestamp(F.col("day"), "dd/MM/yyyy").cast("timestamp_ntz").alias("day"),
    )


@query(
    "calendar_parts",
    """SELECT event_id, year(ts)::INTEGER AS year_e, month(ts)::INTEGER AS month_e, day(ts)::INTEGER AS day_e,
              (isodow(ts) - 1)::INTEGER AS weekday_e, hour(ts)::INTEGER AS hour_e,
              strftime(ts, '%Y%m%d%H') AS hour_id, strftime(ts, '%Y%m%d') AS day_id FROM events""",
)
def calendar_parts(spark, t):
    parts = calendar.calendar_parts(t.events.select("event_id", "ts"), "ts", "_e")
    return parts.select(
        "event_id", "year_e", "month_e", "day_e", "weekday_e", "hour_e",
        calendar.hour_id(F.col("ts")).alias("hour_id"), calendar.day_id(F.col("ts")).alias("day_id"),
    )


@query(
    "dim_time_id",
    """SELECT event_id,
              ((86400 - ceil((epoch_us(ts) % 86400000000) / 1000000.0)) % 86400)::INTEGER AS until_midnight,
              ((epoch_us(ts) % 86400000000) // 1000000)::INTEGER AS since_midnight FROM events""",
)
def dim_time_id(spark, t):
    return t.events.select(
        "event_id",
        calendar.dim_time_id(F.col("ts")).alias("until_midnight"),
        calendar.dim_time_id(F.col("ts"), "since").alias("since_midnight"),
    )


@query(
    "epoch_ms",
    "SELECT event_id, date_trunc('millisecond', ts) AS at FROM events",
)
def epoch_ms(spark, t):
    """Event times through milliseconds since 1970 and back."""
    millis = t.events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return millis.select("event_id", F.timestamp_millis("ms").cast("timestamp_ntz").alias("at"))


@query(
    "from_epoch",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS text,
              strftime(date_trunc('second', ts) + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS local_text FROM events""",
)
def from_epoch(spark, t):
    """Epoch seconds as text, and as the local time of another zone."""
    seconds = t.events.select("event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("s"))
    at = F.timestamp_seconds("s")
    return seconds.select(
        "event_id",
        F.from_unixtime("s").alias("text"),
        stamp_text(F.from_utc_timestamp(at, "Asia/Bangkok")).alias("local_text"),
    )


@query(
    "to_utc",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'Boston' WHEN 'view' THEN 'Seattle' ELSE 'Chicago' END AS city,
              timezone(CASE event_type WHEN 'click' THEN 'America/New_York' WHEN 'view' THEN 'America/Los_Angeles'
                                       ELSE 'America/Chicago' END, ts) AT TIME ZONE 'UTC' AS utc
       FROM events""",
)
def to_utc(spark, t):
    """Event times read as local times of a city."""
    kind = F.col("event_type")
    city = F.when(kind == "click", "Boston").when(kind == "view", "Seattle").otherwise("Chicago")
    zone = (
        F.when(kind == "click", "America/New_York")
        .when(kind == "view", "America/Los_Angeles")
        .otherwise("America/Chicago")
    )
    local = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return calendar.to_utc(local, "ts", zone).select(
        "event_id", city.alias("city"), F.col("utc").cast("timestamp_ntz").alias("utc")
    )


DATE_COLUMNS = """first_day_of_month last_day_of_month first_day_of_quarter last_day_of_quarter
first_day_of_year last_day_of_year first_day_of_next_month first_day_of_next_year""".split()


@query(
    "dim_date",
    """WITH days AS (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders),
                                                   (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d),
            parts AS (SELECT d, day(d) AS dd, date_trunc('month', d)::TIMESTAMP AS m, date_trunc('quarter', d)::TIMESTAMP AS q,
                             date_trunc('year', d)::TIMESTAMP AS y FROM days)
       SELECT strftime(d, '%Y%m%d')::INTEGER AS dim_date_id, strftime(d, '%Y-%m-%d') AS date, dd::INTEGER AS day,
              CASE WHEN dd IN (11, 12, 13) THEN 'th' WHEN dd % 10 = 1 THEN 'st' WHEN dd % 10 = 2 THEN 'nd'
                   WHEN dd % 10 = 3 THEN 'rd' ELSE 'th' END AS day_suffix,
              (dayofweek(d) + 1)::INTEGER AS week_day, dayname(d) AS week_day_name,
              ceil(dd / 7.0)::INTEGER AS "DOW_in_month", dayofyear(d)::INTEGER AS day_of_year,
              ((dd + dayofweek(m) - 1) // 7 + 1)::INTEGER AS week_of_month,
              ((dayofyear(d) + dayofweek(y) - 1) // 7 + 1)::INTEGER AS week_of_year,
              week(d)::INTEGER AS "ISO_week_of_year", month(d)::INTEGER AS month, monthname(d) AS month_name,
              quarter(d)::INTEGER AS quarter,
              CASE quarter(d) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' ELSE 'Fourth' END AS quarter_name,
              year(d)::INTEGER AS year, strftime(d, '%m%Y') AS "MMYYYY", strftime(d, '%b %Y') AS month_year,
              strftime(m, '%Y-%m-%d') AS first_day_of_month, strftime(last_day(d), '%Y-%m-%d') AS last_day_of_month,
              strftime(q, '%Y-%m-%d') AS first_day_of_quarter,
              strftime(q + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS last_day_of_quarter,
              strftime(y, '%Y-%m-%d') AS first_day_of_year,
              strftime(y + INTERVAL 1 YEAR - INTERVAL 1 DAY, '%Y-%m-%d') AS last_day_of_year,
              strftime(m + INTERVAL 1 MONTH, '%Y-%m-%d') AS first_day_of_next_month,
              strftime(y + INTERVAL 1 YEAR, '%Y-%m-%d') AS first_day_of_next_year,
              (SELECT count(*) FROM orders WHERE o_orderdate = d) AS orders
       FROM parts""",
)
def dim_date(spark, t):
    """The date dimension over the order dates, with the orders of each day."""
    low, high = t.orders.select(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    per_day = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    days = calendar.dim_date(spark, low, high).join(per_day, "date", "left")
    texts = {c: F.date_format(c, "yyyy-MM-dd") for c in ["date", *DATE_COLUMNS]}
    return days.withColumns(texts).fillna(0, ["orders"])


@query(
    "dim_time",
    """SELECT strftime(ts, '%H:%M:%S') AS time,
              strftime(ts, '%H:') || CASE WHEN minute(ts) < 30 THEN '00' ELSE '30' END || ':00' AS time_30,
              (hour(ts) * 10000 + minute(ts) * 100 + second(ts))::INTEGER AS time_alt_key,
              (hour(ts) // 6)::INTEGER AS day_time_bucket_group_key,
              CASE hour(ts) // 6 WHEN 0 THEN 'Night' WHEN 1 THEN 'Morning' WHEN 2 THEN 'Afternoon' ELSE 'Evening' END AS day_time_bucket,
              strftime(ts, '%H:00-%H:59') AS hourly_bucket, count(*) AS events
       FROM events GROUP BY ALL""",
)
def dim_time(spark, t):
    """Events by the columns of the time dimension."""
    seconds = t.events.groupBy(calendar.dim_time_id(F.col("ts"), "since").alias("dim_time_id")).agg(
        F.count(F.lit(1)).alias("events")
    )
    columns = ["time", "time_30", "time_alt_key", "day_time_bucket_group_key", "day_time_bucket", "hourly_bucket"]
    return calendar.dim_time(spark).join(seconds, "dim_time_id").select(*columns, "events")


@query(
    "surrogate_key",
    f"SELECT l_partkey, l_suppkey, {_uuid('l_partkey', 'l_suppkey')} AS id FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)",
)
def surrogate_key(spark, t):
    keys = ["l_partkey", "l_suppkey"]
    pairs = t.lineitem.select(*keys).distinct()
    return pairs.withColumn("id", scalars.surrogate_key(*[F.col(k) for k in keys]))


@query("random_key", "SELECT count(*) AS keys FROM supplier")
def random_key(spark, t):
    """Random keys: as many different ones as rows."""
    return t.supplier.select(F.uuid().alias("id")).agg(F.countDistinct("id").alias("keys"))


@query(
    "row_md5",
    """SELECT s_suppkey, md5(concat_ws('_', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR))) AS md5 FROM supplier""",
)
def row_md5(spark, t):
    rows = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return scalars.row_md5(rows).select("s_suppkey", "md5")


@query(
    "status_text",
    """SELECT l_linenumber AS code, CASE l_linenumber WHEN 1 THEN 'In process' WHEN 2 THEN 'Approved' WHEN 3 THEN 'Backordered'
                WHEN 4 THEN 'Rejected' WHEN 5 THEN 'Shipped' WHEN 6 THEN 'Cancelled' ELSE '** Invalid **' END AS status,
              count(*) AS lines FROM lineitem GROUP BY ALL""",
)
def status_text(spark, t):
    return t.lineitem.groupBy(
        F.col("l_linenumber").alias("code"), scalars.status_text(F.col("l_linenumber")).alias("status")
    ).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "status_text_sql",
    """SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'In process' WHEN 2 THEN 'Approved' WHEN 3 THEN 'Backordered'
                WHEN 4 THEN 'Rejected' WHEN 5 THEN 'Shipped' WHEN 6 THEN 'Cancelled' ELSE '** Invalid **' END AS status
       FROM lineitem""",
)
def status_text_sql(spark, t):
    """The same through the SQL function."""
    register_sql_functions(spark)
    return t.lineitem.selectExpr("l_orderkey", "l_linenumber", "order_status_text(l_linenumber) AS status")


@query(
    "line_total",
    """SELECT l_orderkey, l_linenumber,
              coalesce(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2)) * nullif(l_quantity::DECIMAL(6,0), 1), 0)::DOUBLE AS total
       FROM lineitem""",
)
def line_total(spark, t):
    """Exact totals; a quantity of one counts as missing."""
    price, discount = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)")
    quantity = F.nullif(F.col("l_quantity"), F.lit(1.0)).cast("decimal(6,0)")
    amount = scalars.line_total(price, discount, quantity)
    return t.lineitem.select("l_orderkey", "l_linenumber", amount.cast("double").alias("total"))


@query(
    "order_number",
    """SELECT o_orderkey, coalesce('SO' || nullif(o_custkey, 7), '*** ERROR ***') AS number FROM orders""",
)
def order_number(spark, t):
    customer = F.nullif(F.col("o_custkey"), F.lit(7).cast("bigint"))
    return t.orders.select("o_orderkey", scalars.order_number(customer).alias("number"))


@query(
    "total_due",
    """SELECT l_orderkey, l_linenumber,
              (l_extendedprice::DECIMAL(12,2) + l_extendedprice::DECIMAL(12,2) * l_tax::DECIMAL(4,2) + l_quantity::DECIMAL(6,0))::DOUBLE AS due
       FROM lineitem""",
)
def total_due(spark, t):
    """Price, tax and, as freight, one per piece."""
    price, tax = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_tax").cast("decimal(4,2)")
    due = scalars.total_due(price, price * tax, F.col("l_quantity").cast("decimal(6,0)"))
    return t.lineitem.select("l_orderkey", "l_linenumber", due.cast("double").alias("due"))


# Every element of the catalogue in one document; part by part another one is missing.
XML_SQL = ", ".join(f"""CASE WHEN p_size % {len(scalars.CATALOG_PATHS)} <> {i} THEN p_name || ' & {i}' END AS "{name}\"""" for i, name in enumerate(scalars.CATALOG_PATHS))


def _catalog_document():
    """The document of a part, with prefixed names as in the catalogue."""
    tree = {}
    for i, path in enumerate(scalars.CATALOG_PATHS.values()):
        *frames, last = path.split("/")
        at = tree
        for frame in frames:
            at = at.setdefault(frame, {})
        at[last] = i
    prefixes = {"p": "h", "Warranty": "wm", "Maintenance": "wm", "wheel": "wf", "saddle": "wf", "pedal": "wf", "BikeFrame": "wf", "crankset": "wf"}

    def element(name, inner, of="p1"):
        own = prefixes.get(name, of)
        text = F.regexp_replace(F.concat("p_name", F.lit(f" & {inner}")), "&", "&amp;") if isinstance(inner, int) else F.concat(
            *[element(n, x, own if own == "wm" else "p1") for n, x in inner.items()]
        )
        spaces = ' xmlns:p1="urn:model" xmlns:h="urn:html" xmlns:wm="urn:care" xmlns:wf="urn:bike"' if name == "ProductDescription" else ""
        whole = F.concat(F.lit(f"<{own}:{name}{spaces}>"), text, F.lit(f"</{own}:{name}>"))
        return F.when(F.col("p_size") % len(scalars.CATALOG_PATHS) != inner, whole).otherwise("") if isinstance(inner, int) else whole

    return element("ProductDescription", tree["ProductDescription"])


@query("xml_extract", f"SELECT p_partkey, {XML_SQL} FROM part")
def xml_extract(spark, t):
    """All fields of parts as catalogue documents. Their rows are dealt out first: a small file of
    parts, which few tasks read, makes many documents to parse."""
    parts = t.part.select("p_partkey", "p_name", "p_size")
    documents = parts.repartition(*parts.columns).select("p_partkey", _catalog_document().alias("xml"))
    return scalars.xml_fields(documents, "xml", scalars.CATALOG_PATHS).drop("xml")


@query(
    "json_extract",
    """SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k,
              try_cast(json_extract_string(props, '$.missing') AS DOUBLE) AS missing FROM events""",
)
def json_extract(spark, t):
    return t.events.select(
        "event_id",
        scalars.json_number(F.col("props"), "$.k").alias("k"),
        scalars.json_number(F.col("props"), "$.missing").alias("missing"),
    )


@query(
    "json_decode",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
              '{"deviceId":' || user_id || ',"kind":"' || event_type || '"}' AS body FROM events""",
)
def json_decode(spark, t):
    return t.events.select(
        "event_id",
        F.from_json("props", "k INT").getField("k").alias("k"),
        F.to_json(F.struct(F.col("user_id").alias("deviceId"), F.col("event_type").alias("kind"))).alias("body"),
    )


@query(
    "split_concat",
    """SELECT page_id, split_part(host, '.', 1) || '.' || split_part(host, '.', 2) AS host
       FROM (SELECT page_id, split_part(url, '/', 3) AS host FROM pages)""",
)
def split_concat(spark, t):
    host = scalars.split_part(F.col("url"), "/", 2)
    return t.pages.select(
        "page_id",
        F.concat(scalars.split_part(host, ".", 0), F.lit("."), scalars.split_part(host, ".", 1)).alias("host"),
    )


@query(
    "split_tilde",
    """SELECT CAST(o_orderkey AS VARCHAR) AS a, CAST(o_custkey AS VARCHAR) AS b, o_orderstatus AS c,
              o_orderpriority AS d, strftime(o_orderdate, '%Y-%m-%d') AS e, CAST(NULL AS VARCHAR) AS f FROM orders""",
)
def split_tilde(spark, t):
    """Messages of fields joined by ``~``; the sixth field is missing."""
    message = F.concat_ws(
        "~", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return t.orders.select(message.alias("m")).select(*scalars.fields(F.col("m"), "~", list("abcdef")))


@query(
    "regex_extract",
    """SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(url, '://([^/?#]+)', 1) AS host,
              regexp_extract(url, '://[^/?#]+/(.*)$', 1) AS rest FROM pages""",
)
def regex_extract(spark, t):
    return t.pages.select(
        "page_id",
        F.regexp_extract("url", "^(https?)://", 1).alias("scheme"),
        F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"),
        F.regexp_extract("url", "://[^/?#]+/(.*)$", 1).alias("rest"),
    )


@query(
    "parse_kv",
    """WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
       SELECT doc_id, count(*) AS lines, count(*) FILTER (contains(line, ':')) AS pairs,
              coalesce(sum(length(trim(split_part(line, ':', 2)))) FILTER (contains(line, ':')), 0)::BIGINT AS value_length
       FROM lines GROUP BY doc_id""",
)
def parse_kv(spark, t):
    """The ``name: value`` lines among all lines of the documents."""
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    _, value = parse_pair(F.col("line"))
    return lines.select("doc_id", value.alias("value")).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("value").alias("pairs"),
        F.coalesce(F.sum(F.length("value")), F.lit(0)).alias("value_length"),
    )


@query(
    "path_parts",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
              strftime(o_orderdate, '%Y/%m') AS folder FROM orders""",
)
def path_parts(spark, t):
    parts = scalars.path_parts(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", *[c.alias(name) for name, c in parts.items()])


@query("row_id", "SELECT count(*) AS rows, count(*) AS ids FROM lineitem")
def row_id(spark, t):
    """Row ids are unique but differ between runs: their number is compared with the rows'."""
    numbered = t.lineitem.select(F.monotonically_increasing_id().alias("id"))
    return numbered.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"))


def _masked_sql(column: str) -> str:
    text = column
    for pattern in privacy.PATTERNS.values():
        text = f"regexp_replace({text}, '{pattern}', '{privacy.MASK}', 'g')"
    return text


@query("anonymize", f"SELECT doc_id, {_masked_sql('text')} AS text FROM documents")
def anonymize(spark, t):
    return privacy.anonymize(t.documents.select("doc_id", "text"), "text")


@query(
    "anonymize_chat",
    f"SELECT conv_id, turn, role, {_masked_sql('text')} AS text FROM conversations",
)
def anonymize_chat(spark, t):
    return privacy.anonymize(t.conversations.select("conv_id", "turn", "role", "text"), "text")


@query(
    "anonymize_leaks",
    "SELECT count(*) AS documents, 0::BIGINT AS leaking FROM documents",
)
def anonymize_leaks(spark, t):
    """Masked documents that still hold something to mask: none."""
    done = privacy.anonymize(t.documents.select("text"), "text")
    return done.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(privacy.leaks(F.col("text")) > 0).alias("leaking")
    )
