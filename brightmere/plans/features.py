"""The demand feature pipeline on events, parts and their hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightmere.operators import features, models
from brightmere.plans.registry import query
from brightmere.session import scratch

TRIPS = """SELECT ts AS tpep_pickup_datetime, ts + INTERVAL 20 MINUTE AS tpep_dropoff_datetime,
                  CASE WHEN value >= 1 THEN value END AS passenger_count,
                  200 + CAST(json_extract(props, '$.k') AS BIGINT) AS PULocationID,
                  CASE WHEN event_type = 'error' THEN 265 ELSE user_id END AS DOLocationID FROM events"""
CLEAN_TRIPS = f"""SELECT * FROM ({TRIPS}) WHERE passenger_count IS NOT NULL
                  AND PULocationID NOT IN (264, 265) AND DOLocationID NOT IN (264, 265)"""
ZONES = """SELECT p_partkey + 200 AS "LocationID", p_type AS "Borough",
                  CASE WHEN p_brand <> 'Brand#1' THEN p_brand END AS service_zone FROM part"""
CLEAN_ZONES = f"SELECT * FROM ({ZONES}) WHERE service_zone IS NOT NULL"
WEATHER = """SELECT date_trunc('hour', ts) AS time,
                    CASE WHEN max(value) < 200 THEN max(value) END AS temperature_2m_c, min(value) AS precipitation_mm,
                    count(*) AS cloudcover_percentage, max(user_id)::DOUBLE AS windspeed_10m_km_per_hour
             FROM events GROUP BY ALL"""
CLEAN_WEATHER = f"SELECT * FROM ({WEATHER}) WHERE temperature_2m_c IS NOT NULL"
CODES = f"""SELECT "Borough", (dense_rank() OVER (ORDER BY first) - 1)::INTEGER AS borough_id
            FROM (SELECT "Borough", min("LocationID") AS first FROM ({CLEAN_ZONES}) GROUP BY ALL)"""
DEMAND = f"""SELECT hour(tpep_pickup_datetime)::INTEGER AS hour_pickup, day(tpep_pickup_datetime)::INTEGER AS day_pickup,
                    (isodow(tpep_pickup_datetime) - 1)::INTEGER AS weekday_pickup,
                    month(tpep_pickup_datetime)::INTEGER AS month_pickup, z."Borough", borough_id,
                    count(*) AS demand, min(tpep_pickup_datetime) AS pickup_timestamp
             FROM ({CLEAN_TRIPS}) JOIN ({CLEAN_ZONES}) z ON PULocationID = z."LocationID"
             JOIN ({CODES}) c ON c."Borough" = z."Borough" GROUP BY ALL"""


def _trips(t):
    """Events as trips from the zone in their properties; errors end nowhere."""
    return t.events.select(
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.expr("INTERVAL 20 MINUTE")).alias("tpep_dropoff_datetime"),
        F.when(F.col("value") >= 1, F.col("value")).alias("passenger_count"),
        (F.get_json_object("props", "$.k").cast("bigint") + 200).alias("PULocationID"),
        F.when(F.col("event_type") == "error", F.lit(265).cast("bigint")).otherwise(F.col("user_id")).alias("DOLocationID"),
    )


def _zones(t):
    """Parts as zones; those of one brand have no service zone."""
    return t.part.select(
        (F.col("p_partkey") + 200).alias("LocationID"),
        F.col("p_type").alias("Borough"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("service_zone"),
    )


def _weather(t):
    """The weather of an hour, made from its events, as it arrives in a file."""
    return t.events.groupBy(F.date_format("ts", "yyyy-MM-dd'T'HH:00").alias("time")).agg(
        F.when(F.max("value") < 200, F.max("value")).alias("temperature_2m (°C)"),
        F.min("value").alias("precipitation (mm)"),
        F.count(F.lit(1)).alias("cloud_cover (%)"),
        F.max("user_id").cast("double").alias("wind_speed_10m (km/h)"),
    )


@query("cleanse_trips", CLEAN_TRIPS.replace("PULocationID,", '"PULocationID",'))
def cleanse_trips(spark, t):
    return features.cleanse_trips(_trips(t))


@query(
    "cleanse_weather",
    f"SELECT * REPLACE (strftime(time, '%Y-%m-%dT%H:00') AS time) FROM ({CLEAN_WEATHER})",
)
def cleanse_weather(spark, t):
    return features.cleanse_weather(_weather(t))


@query("cleanse_zones", CLEAN_ZONES)
def cleanse_zones(spark, t):
    return features.cleanse_zones(_zones(t))


def _demand(t):
    return features.demand(features.cleanse_trips(_trips(t)), features.cleanse_zones(_zones(t)))


@query("demand_hourly", DEMAND)
def demand_hourly(spark, t):
    return _demand(t)


FEATURES = f"""SELECT *, year(time)::INTEGER AS year, month(time)::INTEGER AS month, day(time)::INTEGER AS day,
                      hour(time)::INTEGER AS hour, strftime(time, '%Y%m%d%H') AS id FROM ({CLEAN_WEATHER})"""


def _weather_features(t):
    return features.weather_features(features.cleanse_weather(_weather(t)))


@query("weather_features", FEATURES)
def weather_features(spark, t):
    return _weather_features(t)


@query(
    "minmax_scale",
    """WITH fit AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_extendedprice) AS c, max(l_extendedprice) AS d
                    FROM lineitem WHERE year(l_shipdate) = 1996)
       SELECT l_orderkey, l_linenumber, (l_quantity - a) / (b - a) AS quantity, (l_extendedprice - c) / (d - c) AS price
       FROM lineitem, fit""",
)
def minmax_scale(spark, t):
    """Scaled by the range of 1996, applied to all years."""
    fit = features.minmax_fit(t.lineitem.where(F.year("l_shipdate") == 1996), ["l_quantity", "l_extendedprice"])
    scaled = features.minmax_apply(t.lineitem, fit, {"l_quantity": "quantity", "l_extendedprice": "price"})
    return scaled.select("l_orderkey", "l_linenumber", "quantity", "price")


def _training(t):
    return features.training_frame(_demand(t), _weather_features(t), 2024)


TRAINING = f"""WITH w AS (SELECT * FROM ({FEATURES}) WHERE year = 2024),
             fit AS (SELECT min(temperature_2m_c) AS t0, max(temperature_2m_c) AS t1,
                            min(windspeed_10m_km_per_hour) AS w0, max(windspeed_10m_km_per_hour) AS w1,
                            min(precipitation_mm) AS p0, max(precipitation_mm) AS p1,
                            min(cloudcover_percentage) AS c0, max(cloudcover_percentage) AS c1 FROM w)
        SELECT borough_id, hour_pickup, day_pickup, weekday_pickup, month_pickup, demand,
               (temperature_2m_c - t0) / (t1 - t0) AS scaled_temperature,
               (windspeed_10m_km_per_hour - w0) / (w1 - w0) AS scaled_windspeed,
               (precipitation_mm - p0) / (p1 - p0) AS scaled_precipitation,
               (cloudcover_percentage - c0) / (c1 - c0)::DOUBLE AS scaled_cloudcover
        FROM ({DEMAND}) JOIN w ON month_pickup = month AND day_pickup = day AND hour_pickup = hour, fit"""


@query("training_frame", TRAINING)
def training_frame(spark, t):
    return _training(t)


@query(
    "train_test_split",
    """SELECT o_orderkey, CASE WHEN ('0x' || substr(md5('13|' || o_orderkey), 1, 8))::BIGINT % 10000 < 8000
                               THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def train_test_split(spark, t):
    train, test = features.split(t.orders.select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


KEYS = ["borough_id", *features.DEMAND_KEYS]


@query("train_demand")
def train_demand(spark, t):
    """Both model families on four fifths of the hours, measured on the rest."""
    path = scratch(spark, "training")
    _training(t).write.parquet(path)
    train, test = features.split(spark.read.parquet(path), KEYS)
    measured = []
    for family in ("gbt", "poisson"):
        model = models.train_demand(train, family=family)
        scored = models.score(model, test)
        measured.append(
            models.regression_metrics(scored, "demand", "prediction").withColumn("family", F.lit(family))
        )
    return measured[0].unionByName(measured[1])


@query(
    "score_demand",
    f"""SELECT borough_id, hour_pickup, day_pickup, weekday_pickup, month_pickup, demand, true AS positive FROM ({TRAINING})
        ORDER BY month_pickup DESC, day_pickup DESC, weekday_pickup DESC, hour_pickup DESC, borough_id DESC LIMIT 30""",
)
def score_demand(spark, t):
    """The last thirty hours and boroughs with their true demand; the prediction is a positive number."""
    path = scratch(spark, "training")
    _training(t).write.parquet(path)
    frame = spark.read.parquet(path)
    train, _ = features.split(frame, KEYS)
    model = models.train_demand(train, family="poisson")
    order = ["month_pickup", "day_pickup", "weekday_pickup", "hour_pickup", "borough_id"]
    newest = frame.orderBy(*[F.col(c).desc() for c in order]).limit(30)
    scored = models.score(model, newest)
    return scored.select(*KEYS, "demand", (F.col("prediction") > 0).alias("positive"))


@query(
    "regression_metrics",
    """SELECT n AS rows, round(mae, 6) AS mae, round(mse, 4) AS mse, round(sqrt(mse), 6) AS rmse, round(1 - mse / spread, 6) AS r2
       FROM (SELECT count(*) AS n, avg(abs(value - k)) AS mae, avg((value - k) * (value - k)) AS mse, var_pop(value) AS spread
             FROM (SELECT value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events))""",
)
def regression_metrics(spark, t):
    """How well the number in the properties predicts the value."""
    rows = t.events.select("value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    found = models.regression_metrics(rows, "value", "k")
    return found.select(
        "rows", F.round("mae", 6).alias("mae"), F.round("mse", 4).alias("mse"),
        F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"),
    )


@query(
    "register_feature_set",
    """SELECT 'demand' AS name, 1::BIGINT AS version, 'pickup_timestamp' AS timestamp_column, count(*) AS rows FROM ({0})
       UNION ALL SELECT 'weather', 1, 'time', count(*) FROM ({1})""".format(DEMAND, FEATURES),
)
def register_feature_set(spark, t):
    """Both feature sets stored, registered and read back by name."""
    registry = scratch(spark, "registry")
    counts = []
    for name, rows, ts, index in (
        ("demand", _demand(t), "pickup_timestamp", ["borough_id"]),
        ("weather", _weather_features(t), "time", ["id"]),
    ):
        path = scratch(spark, name)
        rows.write.parquet(path)
        features.register(spark, registry, name, path, rows.schema, ts, index, version=1)
        stored = features.read_feature_set(spark, registry, name)
        counts.append(stored.agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(name)))
    listed = spark.read.schema(features.REGISTRY_LAYOUT).parquet(registry).select("name", "version", "timestamp_column")
    return listed.join(counts[0].unionByName(counts[1]), "name")


SHARE = f"('0x' || substr(md5(concat_ws('|', 13, {', '.join(KEYS)})), 1, 8))::BIGINT % 10000"


@query(
    "train_demand_trees",
    f"""SELECT CASE WHEN {SHARE} < 8000 THEN 'train' ELSE 'test' END AS part, count(*) AS rows, true AS positive, CASE WHEN part = 'train' THEN true END AS better
        FROM ({TRAINING}) GROUP BY part""",
)
def train_demand_trees(spark, t):
    """Boosted trees with the Poisson objective, ten rounds of them: the rows of both parts, whether
    all predictions are positive, and whether the deviance of the rows learned from is below that of
    their mean."""
    path = scratch(spark, "training")
    _training(t).write.parquet(path)
    train, test = features.split(spark.read.parquet(path), KEYS)
    model = models.train_demand(train, family="poisson_trees", rounds=10)
    parts = []
    for part, rows in (("train", train), ("test", test)):
        y, p = F.col("demand").cast("double"), F.col("prediction")
        scored = models.score(model, rows)
        # The deviance up to a term that has no prediction in it.
        total = scored.agg(
            F.count(F.lit(1)).alias("rows"), F.min(p > 0).alias("positive"), F.sum(p - y * F.log(p)).alias("deviance"),
            F.avg(y).alias("mean"), F.sum(y).alias("sum"),
        )
        of_mean = F.col("rows") * F.col("mean") - F.col("sum") * F.log("mean")
        better = F.when(F.lit(part) == "train", F.col("deviance") < of_mean)
        parts.append(total.select(F.lit(part).alias("part"), "rows", "positive", better.alias("better")))
    return parts[0].unionByName(parts[1])
