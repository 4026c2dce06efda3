"""The given tables seen as telemetry, dimensions, anomalies and vehicle events.

``Tables`` builds the views as Spark plans; ``CTES`` states the same views in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens import session

# Explicit schemas: timestamps without a zone are read as UTC instants, and only the columns a
# query uses reach the scan.
_EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
_EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"
_SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"

KINDS = ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")
START = "2024-01-01 00:00:00"
END = "2024-01-31 00:00:00"
CUTOFF = "2024-01-20 00:00:00"


def _asset():
    return F.concat(F.lit("A0"), (F.col("user_id") % 3).cast("string"))


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.prepare(spark)
        self.dir = sf_dir

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.dir}/{name}.parquet")

    def _dimension(self, name: str, build) -> DataFrame:
        """A dimension that a deployment reads from a file: written once per session, so that
        plans see a table of known size, as they would there."""
        return session.hold_once(self.spark, f"{self.dir} {name}", build)

    @cached_property
    def events(self) -> DataFrame:
        return self._read("events", _EVENTS).withColumn("asset", _asset())

    @cached_property
    def telemetry(self) -> DataFrame:
        """Three assets with five sensors each."""
        tag = F.concat("asset", F.lit("_"), F.upper("event_type"))
        return self.events.select(F.col("ts").alias("timestamp"), tag.alias("tag"), "value")

    @cached_property
    def tags(self) -> DataFrame:
        kind = F.col("event_type")

        def build() -> DataFrame:
            return self.events.select("asset", "event_type").distinct().select(
                F.concat("asset", F.lit("_"), F.upper(kind)).alias("tag"),
                F.concat(kind, F.lit(" [unit]")).alias("metric"),
                F.concat(kind, F.lit("-"), "asset").alias("component"),
                "asset",
            )

        return self._dimension("tags", build)

    @cached_property
    def features(self) -> DataFrame:
        kinds = F.array(*[F.lit(k) for k in KINDS])
        ordinal = F.array_position(kinds, F.substring_index("tag", "_", -1)).cast("int")
        return self.tags.select("tag", ordinal.alias("ordinal"), "asset")

    @cached_property
    def assets(self) -> DataFrame:
        key = F.col("s_suppkey").cast("string")
        code = F.when(F.length(key) < 2, F.concat(F.lit("0"), key)).otherwise(key)
        nation = F.col("s_nationkey").cast("double")
        return self._read("supplier", _SUPPLIER).select(
            F.concat(F.lit("A"), code).alias("AssetID"),
            F.col("s_name").alias("AssetCode"),
            F.lit("Compressor").alias("AssetType"),
            F.lit("Maker").alias("Manufacturer"),
            F.lit("M1").alias("Model"),
            (F.lit(25.0) + nation * 0.5).alias("Latitude"),
            (F.lit(-100.0) + nation * 0.25).alias("Longitude"),
        )

    @cached_property
    def _errors(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "error").select(
            "event_id",
            "asset",
            F.col("ts").alias("timestamp"),
            (F.col("value") / 100.0).alias("score"),
            F.least(F.lit(1.0), F.col("value") / 250.0).alias("severity"),
            (F.col("value") >= 12.5).alias("is_anomaly"),
        )

    @cached_property
    def anomalies(self) -> DataFrame:
        return self._errors.drop("event_id")

    @cached_property
    def explanations(self) -> DataFrame:
        """Every anomaly with the five sensors of its asset and two partners for each."""
        kinds = F.array(*[F.lit(k) for k in KINDS])
        event, at = F.col("event_id"), F.col("at")
        ordinal = at + 1

        def partner(shift: int):
            return F.concat("asset", F.lit("_"), F.element_at(kinds, (at + shift) % 5 + 1))

        return self._errors.select("*", F.posexplode(kinds).alias("at", "kind")).select(
            "asset", "timestamp", "score", "severity", "is_anomaly",
            F.concat("asset", F.lit("_"), "kind").alias("tag"),
            ((event * 7 + ordinal * 13) % 100 / F.lit(250.0)).alias("contribution_score"),
            F.struct(
                F.array(partner(1), partner(2)).alias("changed_variables"),
                F.array(
                    (event + ordinal) % 10 / F.lit(10.0), (event + 2 * ordinal) % 10 / F.lit(10.0)
                ).alias("changed_values"),
            ).alias("correlation_changes"),
        )

    @cached_property
    def interpreted(self) -> DataFrame:
        """Anomalies with their explanation as JSON text, as they travel on the wire."""
        kinds = F.array(*[F.lit(k) for k in KINDS])
        event = F.col("event_id")

        def part(kind, at):
            ordinal = at + 1
            name = F.concat(F.col("asset"), F.lit("_"), kind)
            partners = [
                F.concat(F.col("asset"), F.lit("_"), F.element_at(kinds, (at + s) % 5 + 1))
                for s in (1, 2)
            ]
            return F.struct(
                name.alias("tag"),
                ((event * 7 + ordinal * 13) % 100 / F.lit(250.0)).alias("contribution_score"),
                F.struct(
                    F.array(*partners).alias("changed_variables"),
                    F.array(
                        (event + ordinal) % 10 / F.lit(10.0),
                        (event + 2 * ordinal) % 10 / F.lit(10.0),
                    ).alias("changed_values"),
                ).alias("correlation_changes"),
            )

        return self._errors.withColumn(
            "interpretation", F.to_json(F.transform(kinds, part))
        ).drop("event_id")

    @cached_property
    def models(self) -> DataFrame:
        days = F.array(*[F.lit(f"2024-01-{d} 00:00:00") for d in ("05", "15", "25")])
        number = (F.col("at") + 1).cast("string")

        def build() -> DataFrame:
            trained = self.events.select("asset").distinct()
            return trained.select("asset", F.posexplode(days).alias("at", "day")).select(
                "asset",
                F.concat(F.lit("models/"), "asset", F.lit("/"), number).alias("model_uri"),
                F.lit(280).alias("sliding_window"),
                F.col("day").cast("timestamp").alias("effective_date"),
            )

        return self._dimension("models", build)

    @cached_property
    def vehicles(self) -> DataFrame:
        shift = F.col("value") / 100.0
        return self.events.select(
            F.concat(F.lit("Truck"), F.col("user_id").cast("string")).alias("vehicle_id"),
            "event_id",
            F.col("ts").alias("timestamp"),
            (F.lit(30.0) + shift).alias("lat"),
            (F.lit(-98.0) - shift).alias("lon"),
        )

    @cached_property
    def embeddings(self) -> DataFrame:
        return self._read("embeddings", _EMBEDDINGS)

    @cached_property
    def readings(self) -> DataFrame:
        """Ten assets with 64 sensors: one embedding is one minute of its label's asset."""
        asset = F.concat(F.lit("E"), F.col("label").cast("string"))
        base = F.unix_micros(F.lit(START).cast("timestamp"))
        at = F.timestamp_micros(base + F.col("vec_id") * 60_000_000)
        return self.embeddings.select(
            at.alias("timestamp"), asset.alias("asset"), F.posexplode("embedding").alias("at", "v")
        ).select(
            "timestamp",
            F.concat("asset", F.lit("_"), F.lpad(F.col("at").cast("string"), 2, "0")).alias("tag"),
            F.col("v").cast("double").alias("value"),
        )

    @cached_property
    def reading_features(self) -> DataFrame:
        """Sensors per label, from one size per label rather than from the exploded readings."""
        asset = F.concat(F.lit("E"), F.col("label").cast("string"))

        def build() -> DataFrame:
            sizes = self.embeddings.groupBy(asset.alias("asset")).agg(
                F.max(F.size("embedding")).alias("d")
            )
            place = F.lpad((F.col("ordinal") - 1).cast("string"), 2, "0")
            return sizes.select(
                "asset", F.explode(F.sequence(F.lit(1), F.col("d"))).alias("ordinal")
            ).select(F.concat("asset", F.lit("_"), place).alias("tag"), "ordinal", "asset")

        return self._dimension("reading-features", build)


# The same views for the SQL side.
_A = "concat('A0', CAST(user_id % 3 AS VARCHAR))"
_KINDS_SQL = "['" + "', '".join(KINDS) + "']"

CTES = {
    "telemetry": (
        f"SELECT ts AS timestamp, concat({_A}, '_', upper(event_type)) AS tag, value FROM events"
    ),
    "tags": (
        f"SELECT DISTINCT concat({_A}, '_', upper(event_type)) AS tag, "
        f"concat(event_type, ' [unit]') AS metric, concat(event_type, '-', {_A}) AS component, "
        f"{_A} AS asset FROM events"
    ),
    "features": (
        f"SELECT DISTINCT concat({_A}, '_', upper(event_type)) AS tag, "
        f"CAST(list_position({_KINDS_SQL}, upper(event_type)) AS INTEGER) AS ordinal, "
        f"{_A} AS asset FROM events"
    ),
    "assets": (
        "SELECT concat('A', CASE WHEN s_suppkey < 10 THEN '0' ELSE '' END, "
        "CAST(s_suppkey AS VARCHAR)) AS AssetID, s_name AS AssetCode, "
        "'Compressor' AS AssetType, 'Maker' AS Manufacturer, 'M1' AS Model, "
        "25.0::DOUBLE + s_nationkey * 0.5::DOUBLE AS Latitude, "
        "-100.0::DOUBLE + s_nationkey * 0.25::DOUBLE AS Longitude FROM supplier"
    ),
    "errors": (
        f"SELECT event_id, {_A} AS asset, ts AS timestamp, value / 100.0::DOUBLE AS score, "
        "least(1.0::DOUBLE, value / 250.0::DOUBLE) AS severity, value >= 12.5 AS is_anomaly "
        "FROM events WHERE event_type = 'error'"
    ),
    "anomalies": "SELECT asset, timestamp, score, severity, is_anomaly FROM errors",
    "kinds": (
        f"SELECT unnest({_KINDS_SQL}) AS kind, unnest(range(1, {len(KINDS) + 1})) AS ordinal"
    ),
    "explanations": (
        "SELECT asset, timestamp, score, severity, is_anomaly, concat(asset, '_', kind) AS tag, "
        "((event_id * 7 + ordinal * 13) % 100) / 250.0::DOUBLE AS contribution_score, "
        f"[concat(asset, '_', {_KINDS_SQL}[ordinal % 5 + 1]), "
        f"concat(asset, '_', {_KINDS_SQL}[(ordinal + 1) % 5 + 1])] AS changed_variables, "
        "[((event_id + ordinal) % 10) / 10.0::DOUBLE, "
        "((event_id + 2 * ordinal) % 10) / 10.0::DOUBLE] AS changed_values FROM errors, kinds"
    ),
    "models": (
        f"SELECT asset, concat('models/', asset, '/', CAST(n AS VARCHAR)) AS model_uri, "
        "280 AS sliding_window, TIMESTAMP '2023-12-26' + n * INTERVAL 10 DAY AS effective_date "
        f"FROM (SELECT DISTINCT {_A} AS asset FROM events), (SELECT unnest([1, 2, 3]) AS n)"
    ),
    "vehicles": (
        "SELECT concat('Truck', CAST(user_id AS VARCHAR)) AS vehicle_id, event_id, "
        "ts AS timestamp, 30.0::DOUBLE + value / 100.0::DOUBLE AS lat, "
        "-98.0::DOUBLE - value / 100.0::DOUBLE AS lon FROM events"
    ),
    "readings": (
        "SELECT TIMESTAMP '2024-01-01' + to_minutes(vec_id) AS timestamp, "
        "concat('E', CAST(label AS VARCHAR)) AS asset, "
        "concat('E', CAST(label AS VARCHAR), '_', lpad(CAST(i AS VARCHAR), 2, '0')) AS tag, "
        "CAST(embedding[i + 1] AS DOUBLE) AS value "
        "FROM (SELECT vec_id, label, embedding, unnest(range(len(embedding))) AS i FROM embeddings)"
    ),
}
_NEEDS = {"anomalies": ("errors",), "explanations": ("errors", "kinds")}


def sql(views: str, body: str) -> str:
    """``WITH`` the named views (space-separated) in front of a body, which may add its own."""
    names: list[str] = []
    for view in views.split():
        for name in (*_NEEDS.get(view, ()), view):
            if name not in names:
                names.append(name)
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
