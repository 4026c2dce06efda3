"""Multi-sensor detector: moments, correlations, scores, explanations, model table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sensorlens import session
from sensorlens.functions import timing
from sensorlens.operators import fitdays, mvad
from sensorlens.plans.fixtures import CUTOFF, START, sql
from sensorlens.plans.registry import query, rounded
from sensorlens.sources import files, schemas

STEP = "1min"
# The readings' own split: the first three fifths of their time train the detector.
_SPLIT = (
    "(SELECT TIMESTAMP '2024-01-01' + to_minutes(max(vec_id) * 3 // 5) FROM embeddings)"
)

_BINS = "bins AS (SELECT asset, timestamp, tag, avg(value) AS v FROM readings GROUP BY ALL)"
_MOMENTS = (
    f"{_BINS}, m AS (SELECT asset, tag, avg(v) AS mean, stddev_samp(v) AS sd, count(*) AS bins "
    f"FROM bins WHERE timestamp < {_SPLIT} GROUP BY ALL)"
)
_Z = (
    f"{_MOMENTS}, z AS (SELECT asset, tag, timestamp, coalesce(CASE WHEN sd > 0 "
    "THEN (v - mean) / sd END, 0) AS z FROM bins JOIN m USING (asset, tag))"
)
_SCORES = (
    f"{_Z}, t AS (SELECT asset, timestamp, sum(z * z) / count(*) AS score FROM z GROUP BY ALL), "
    "lim AS (SELECT asset, quantile_disc(score, 0.99) AS threshold FROM t "
    f"WHERE timestamp < {_SPLIT} GROUP BY asset), "
    "s AS (SELECT asset, timestamp, score, score > threshold AS is_anomaly, "
    "CASE WHEN score > threshold THEN 1 - threshold / score ELSE 0 END AS severity "
    "FROM t JOIN lim USING (asset))"
)


def _split(t) -> datetime:
    newest = t.embeddings.agg(F.max("vec_id")).first()[0]
    return datetime.fromisoformat(START) + timedelta(minutes=newest * 3 // 5)


def _past(t):
    past = t.readings.filter(F.col("timestamp") < timing.literal(_split(t)))
    return session.hold(mvad.asset_frames(past, t.reading_features, STEP), "frames")


@query(
    "mvad_moments",
    sql(
        "readings",
        f"WITH {_MOMENTS} SELECT asset, tag, round(mean, 6) AS mean, round(sd, 6) AS sd, bins FROM m",
    ),
)
def _(t):
    return rounded(mvad.mvad_moments(_past(t), t.reading_features), "mean", "sd")


@query(
    "mvad_correlations",
    sql(
        "readings",
        f"""
        WITH {_BINS}
        SELECT a.asset AS asset, a.tag AS tag, b.tag AS tag1, round(corr(a.v, b.v), 6) AS correlation
        FROM bins a JOIN bins b USING (asset, timestamp)
        WHERE a.tag <= b.tag AND timestamp < {_SPLIT} GROUP BY ALL
        """,
    ),
)
def _(t):
    past = _past(t)
    scales = mvad.scales(past, t.reading_features)
    matrix = mvad.correlations(mvad.vectors(past, scales)).join(scales, "asset")
    return rounded(mvad.correlation_rows(matrix), "correlation")


def _diagonal(t):
    frames = session.hold(mvad.asset_frames(t.readings, t.reading_features, STEP), "frames")
    model = mvad.mvad_fit(frames, t.reading_features, _split(t), mode="diagonal")
    return mvad.vectors(frames, model), model


@query(
    "mvad_score_diag",
    sql(
        "readings",
        f"WITH {_SCORES} SELECT asset, timestamp, round(score, 6) AS score, "
        "round(severity, 6) AS severity, is_anomaly, 0 AS missing FROM s",
    ),
)
def _(t):
    return rounded(mvad.mvad_score(*_diagonal(t)), "score", "severity")


@query(
    "mvad_contributions",
    sql(
        "readings",
        f"WITH {_SCORES} SELECT asset, timestamp, tag, round(s.severity, 6) AS severity, "
        "round(z * z / sum(z * z) OVER (PARTITION BY asset, timestamp), 6) AS contribution_score "
        "FROM s JOIN z USING (asset, timestamp) WHERE is_anomaly",
    ),
)
def _(t):
    out = mvad.mvad_contributions(*_diagonal(t)).select(
        "asset", "timestamp", "tag", "severity", "contribution_score"
    )
    return rounded(out, "severity", "contribution_score")


def _full(t):
    frames = session.hold(mvad.asset_frames(t.telemetry, t.features, "1hour"), "frames")
    model = mvad.mvad_fit(frames, t.features, CUTOFF, window=48)
    return mvad.vectors(frames, model), model


# The full mode on five sensors: Cholesky factor of the correlations, written out column by column,
# then forward and back substitution for each bin.
_D = range(1, 6)


def _factor() -> str:
    """Views that end in ``g5``: columns l11 to l55 of each asset's factor."""
    cells = ", ".join(
        f"{mvad.RIDGE}::DOUBLE + 1 AS a{i}{j}" if i == j
        else f"coalesce(sum(z{i} * z{j}) / nullif(sqrt(sum(z{i} * z{i}) * sum(z{j} * z{j})), 0), 0) AS a{i}{j}"
        for i in _D for j in _D if j <= i
    )
    views = [f"g0 AS (SELECT asset, {cells} FROM w WHERE timestamp < TIMESTAMP '{CUTOFF}' GROUP BY asset)"]
    for j in _D:
        past = "".join(f" - l{j}{k} * l{j}{k}" for k in range(1, j))
        views.append(f"h{j} AS (SELECT *, sqrt(a{j}{j}{past}) AS l{j}{j} FROM g{j - 1})")
        below = "".join(
            f", (a{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j)) + f") / l{j}{j} AS l{i}{j}"
            for i in _D if i > j
        )
        views.append(f"g{j} AS (SELECT *{below} FROM h{j})")
    return ", ".join(views)


def _solved() -> str:
    """Views that end in ``t``: each bin's z1 to z5, x1 to x5 (the inverse times z) and score."""
    views = ["y0 AS (SELECT * FROM w JOIN g5 USING (asset))"]
    for i in _D:
        past = "".join(f" - l{i}{k} * y{k}" for k in range(1, i))
        views.append(f"y{i} AS (SELECT *, (z{i}{past}) / l{i}{i} AS y{i} FROM y{i - 1})")
    views.append("x6 AS (SELECT * FROM y5)")
    for i in reversed(_D):
        past = "".join(f" - l{k}{i} * x{k}" for k in _D if k > i)
        views.append(f"x{i} AS (SELECT *, (y{i}{past}) / l{i}{i} AS x{i} FROM x{i + 1})")
    total = " + ".join(f"z{i} * x{i}" for i in _D)
    views.append(f"t AS (SELECT *, ({total}) / 5 AS score FROM x1)")
    return ", ".join(views)


_WIDE = ", ".join(f"sum(CASE WHEN ordinal = {i} THEN z ELSE 0 END) AS z{i}" for i in _D)
_FULL = f"""
    hours AS (
        SELECT asset, ordinal, features.tag, time_bucket(INTERVAL 1 HOUR, timestamp) AS timestamp, avg(value) AS v
        FROM telemetry JOIN features USING (tag) GROUP BY ALL),
    mm AS (SELECT tag, avg(v) AS mean, stddev_samp(v) AS sd FROM hours WHERE timestamp < TIMESTAMP '{CUTOFF}' GROUP BY tag),
    zz AS (SELECT asset, ordinal, hours.tag, timestamp, coalesce((v - mean) / nullif(sd, 0), 0) AS z FROM hours JOIN mm USING (tag)),
    w AS (SELECT asset, timestamp, {_WIDE}, CAST(5 - count(*) AS INTEGER) AS missing FROM zz GROUP BY ALL),
    {_factor()}, {_solved()},
    lim AS (SELECT asset, quantile_disc(score, 0.99) AS threshold FROM t WHERE timestamp < TIMESTAMP '{CUTOFF}' GROUP BY asset),
    s AS (SELECT t.*, score > threshold AS is_anomaly,
        CASE WHEN score > threshold THEN 1 - threshold / score ELSE 0 END AS severity FROM t JOIN lim USING (asset))
"""
_PAIRS_OF_FIVE = [(i, j) for i in _D for j in _D if i < j]
_TOLD = f"""
    {_FULL.strip()},
    tags5 AS (SELECT asset, ordinal, tag FROM features),
    trained AS (SELECT asset, unnest([{", ".join(str(i) for i, _ in _PAIRS_OF_FIVE)}]) AS i,
        unnest([{", ".join(str(j) for _, j in _PAIRS_OF_FIVE)}]) AS j, unnest([{", ".join(f"a{j}{i}" for i, j in _PAIRS_OF_FIVE)}]) AS r FROM g0),
    near AS (SELECT s.asset, s.timestamp, {", ".join(f"corr(w.z{i}, w.z{j}) AS r{i}{j}" for i, j in _PAIRS_OF_FIVE)}
        FROM s JOIN w ON w.asset = s.asset AND w.timestamp BETWEEN s.timestamp - INTERVAL 47 HOUR AND s.timestamp
        WHERE is_anomaly GROUP BY ALL),
    moved AS (SELECT asset, timestamp, unnest([{", ".join(str(i) for i, _ in _PAIRS_OF_FIVE)}]) AS i,
        unnest([{", ".join(str(j) for _, j in _PAIRS_OF_FIVE)}]) AS j, unnest([{", ".join(f"r{i}{j}" for i, j in _PAIRS_OF_FIVE)}]) AS now FROM near),
    change AS (SELECT asset, timestamp, i, j, abs(now - r) AS change FROM moved JOIN trained USING (asset, i, j) WHERE NOT isnan(now)),
    both_ways AS (SELECT asset, timestamp, i AS ordinal, j AS other, change FROM change
        UNION ALL SELECT asset, timestamp, j, i, change FROM change),
    ranked AS (SELECT b.asset, timestamp, b.ordinal, list(o.tag ORDER BY change DESC, o.tag) AS changed_variables,
        list(round(change, 6) ORDER BY change DESC, o.tag) AS changed_values
        FROM both_ways b JOIN tags5 o ON o.asset = b.asset AND o.ordinal = b.other GROUP BY ALL),
    shares AS (SELECT asset, timestamp, score, severity, is_anomaly, unnest([1, 2, 3, 4, 5]) AS ordinal,
        unnest([{", ".join(f"greatest(z{i} * x{i}, 0)" for i in _D)}]) AS part,
        {" + ".join(f"greatest(z{i} * x{i}, 0)" for i in _D)} AS whole FROM s WHERE is_anomaly),
    told AS (SELECT asset, timestamp, score, severity, is_anomaly, tag, part / whole AS contribution_score,
        coalesce(changed_variables, []) AS changed_variables, coalesce(changed_values, []) AS changed_values
        FROM shares JOIN tags5 USING (asset, ordinal) LEFT JOIN ranked USING (asset, timestamp, ordinal))
"""


@query(
    "mvad_score",
    sql(
        "telemetry features",
        f"WITH {_FULL.strip()} SELECT asset, timestamp, round(score, 6) AS score, "
        "round(severity, 6) AS severity, is_anomaly, missing FROM s",
    ),
)
def _(t):
    return rounded(mvad.mvad_score(*_full(t)), "score", "severity")


@query(
    "mvad_explain",
    sql(
        "telemetry features",
        f"WITH {_TOLD.strip()} SELECT asset, timestamp, round(score, 6) AS score, round(severity, 6) AS severity, "
        "is_anomaly, tag, round(contribution_score, 6) AS contribution_score, changed_variables, changed_values FROM told",
    ),
)
def _(t):
    vecs, model = _full(t)
    out = mvad.mvad_explain(vecs, model, "1hour", window=48).select("*", "correlation_changes.*")
    out = out.withColumn("changed_values", F.transform("changed_values", lambda v: F.round(v, 6)))
    return rounded(out.drop("correlation_changes"), "score", "severity", "contribution_score")


@query(
    "mvad_new_anomalies",
    sql(
        "telemetry features anomalies",
        f"""
        WITH {_TOLD.strip()},
        stored AS (SELECT asset, max(timestamp) AS newest FROM anomalies WHERE timestamp < TIMESTAMP '{CUTOFF}' GROUP BY asset),
        texts AS (SELECT asset, timestamp, list(tag ORDER BY tag) AS tags,
            list(round(contribution_score, 6) ORDER BY tag) AS contributions,
            list(changed_values ORDER BY tag) AS changes FROM told GROUP BY ALL)
        SELECT CAST(is_anomaly AS BIGINT) AS is_anomaly, s.asset, s.timestamp, round(score, 6) AS score,
            round(severity, 6) AS severity, tags, contributions, changes
        FROM s LEFT JOIN stored USING (asset) LEFT JOIN texts USING (asset, timestamp)
        WHERE newest IS NULL OR s.timestamp > newest
        """,
    ),
)
def _(t):
    _, model = _full(t)
    stored = t.anomalies.filter(F.col("timestamp") < F.lit(CUTOFF).cast("timestamp"))
    out = mvad.mvad_new_anomalies(t.telemetry, t.features, model, stored, "1hour", window=48)
    # The interpretation's text, read back.
    told = out.withColumn("told", F.from_json("interpretation", schemas.INTERPRETATION)).select(
        "is_anomaly", "asset", "timestamp", "score", "severity",
        F.col("told.tag").alias("tags"),
        # Spark's round drops the sign of a negative zero (a missing sensor's share), which SQL's keeps.
        F.transform("told.contribution_score", lambda v: F.when(v == 0, v).otherwise(F.round(v, 6))).alias("contributions"),
        F.transform("told", lambda p: F.transform(p["correlation_changes"]["changed_values"], lambda v: F.round(v, 6))).alias("changes"),
    )
    return rounded(told, "score", "severity")


@query(
    "window_correlations",
    sql(
        "telemetry features",
        """
        WITH bins AS (
            SELECT asset, tag, time_bucket(INTERVAL 1 HOUR, timestamp) AS timestamp, avg(value) AS v
            FROM telemetry JOIN features USING (tag) GROUP BY ALL),
        m AS (SELECT tag, avg(v) AS mean, stddev_samp(v) AS sd FROM bins GROUP BY tag),
        z AS (
            SELECT x.asset, x.timestamp, features.tag, coalesce((v - mean) / sd, 0) AS z
            FROM (SELECT DISTINCT asset, timestamp FROM bins) x JOIN features USING (asset)
            JOIN m USING (tag) LEFT JOIN bins
                ON bins.tag = features.tag AND bins.timestamp = x.timestamp),
        pairs AS (
            SELECT a.asset, a.timestamp, a.tag, b.tag AS tag1, corr(a.z, b.z) OVER (
                PARTITION BY a.tag, b.tag ORDER BY a.timestamp
                RANGE BETWEEN INTERVAL 47 HOUR PRECEDING AND CURRENT ROW) AS r
            FROM z a JOIN z b ON a.asset = b.asset AND a.timestamp = b.timestamp
                AND a.tag <= b.tag)
        SELECT asset, timestamp, tag, tag1, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6)
            AS correlation FROM pairs
        """,
    ),
)
def _(t):
    frames = session.hold(mvad.asset_frames(t.telemetry, t.features, "1hour"), "frames")
    scales = session.hold(mvad.scales(frames, t.features), "scales")
    vecs = session.hold(mvad.vectors(frames, scales), "vectors")
    moved = mvad.window_correlations(vecs.select("asset", "timestamp"), vecs, "1hour", 48)
    matrix = moved.withColumnRenamed("window_correlation", "correlation").join(scales, "asset")
    return rounded(mvad.correlation_rows(matrix, ["asset", "timestamp"]), "correlation")


@query(
    "model_registry",
    sql(
        "models",
        "SELECT asset, max_by(model_uri, effective_date) AS model_uri, "
        "max_by(sliding_window, effective_date) AS sliding_window, "
        "max(effective_date) AS effective_date FROM models GROUP BY asset",
    ),
)
def _(t):
    path = session.scratch_dir(t.spark, "models")
    # One append per training date, as trainings happen one after the other.
    for day in ("2024-01-05", "2024-01-15", "2024-01-25"):
        mvad.register_model(t.models.filter(F.to_date("effective_date") == F.lit(day)), path)
    return mvad.pick_model(t.spark.read.parquet(path), "2024-02-01 00:00:00")


@query(
    "model_registry_retried",
    sql("models", "SELECT asset, model_uri, sliding_window, effective_date FROM models"),
)
def _(t):
    path = session.scratch_dir(t.spark, "models")
    for day in ("2024-01-05", "2024-01-15", "2024-01-15", "2024-01-25", "2024-01-05"):
        trained = t.models.filter(F.to_date("effective_date") == F.lit(day))
        mvad.register_model(trained, path, batch=day)
    return t.spark.read.schema(f"{schemas.MODELS}, batch string").parquet(path).drop("batch")


@query(
    "new_anomalies",
    sql(
        "anomalies",
        """
        WITH stored AS (SELECT asset, max(timestamp) AS newest FROM anomalies
            WHERE severity > 0.9 GROUP BY asset)
        SELECT anomalies.* FROM anomalies LEFT JOIN stored USING (asset)
        WHERE newest IS NULL OR timestamp > newest
        """,
    ),
)
def _(t):
    return mvad.new_anomalies(t.anomalies, t.anomalies.filter(F.col("severity") > 0.9))


@query(
    "fit_report",
    sql(
        "telemetry features",
        f"""
        SELECT asset, count(*) AS total_rows, count(*) FILTER (timestamp < '{CUTOFF}') AS train_rows,
            count(*) FILTER (timestamp >= '{CUTOFF}') AS test_rows,
            count(DISTINCT tag) AS features, TIMESTAMP '{CUTOFF}' AS cutoff, 280 AS sliding_window
        FROM telemetry JOIN features USING (tag) GROUP BY asset
        """,
    ),
)
def _(t):
    return mvad.fit_report(t.telemetry, t.features, CUTOFF)


# Stored fit state: history first, then some days, the last of them again, and one more.
_STORED_RUNS = (
    ("2024-01-01", "2024-01-14"), ("2024-01-15", "2024-01-18"), ("2024-01-18", "2024-01-18"),
    ("2024-01-19", "2024-01-19"),
)
_stored: dict[tuple[str, str], str] = {}


def _fit_state(t) -> str:
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _stored or not session.exists(t.spark, _stored[key]):
        path = session.scratch_dir(t.spark, "fit-state")
        files.append_telemetry(t.telemetry, f"{path}/telemetry", files_per_date=2)
        for first, last in _STORED_RUNS:
            fitdays.store_range(
                t.spark, f"{path}/telemetry", t.features, f"{path}/days", first, last, "1hour", "diagonal"
            )
        _stored[key] = path
    return f"{_stored[key]}/days"


def _merged(t):
    pairs = t.spark.read.schema(fitdays.PAIRS).parquet(f"{_fit_state(t)}/pairs")
    return session.hold(fitdays.merged_pairs(pairs), "merged")


_HOURS = (
    "bins AS (SELECT asset, tag, time_bucket(INTERVAL 1 HOUR, timestamp) AS timestamp, "
    "avg(value) AS v FROM telemetry JOIN features USING (tag) GROUP BY ALL)"
)
_PAST = f"{_HOURS}, past AS (SELECT * FROM bins WHERE timestamp < TIMESTAMP '{CUTOFF}')"


@query(
    "fit_days_moments",
    sql(
        "telemetry features",
        f"WITH {_PAST} SELECT asset, tag, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd, "
        "count(*) AS bins FROM past GROUP BY ALL",
    ),
)
def _(t):
    return rounded(fitdays.merged_moments(_merged(t)), "mean", "sd")


@query(
    "fit_days_correlations",
    sql(
        "telemetry features",
        f"""
        WITH {_PAST},
        m AS (SELECT tag, avg(v) AS mean, sqrt(var_pop(v) * count(*)) AS size FROM past GROUP BY tag)
        SELECT a.asset, a.tag, b.tag AS tag1,
            round(sum((a.v - x.mean) * (b.v - y.mean)) / (any_value(x.size) * any_value(y.size)), 6) AS correlation
        FROM past a JOIN past b ON a.asset = b.asset AND a.timestamp = b.timestamp AND a.tag <= b.tag
        JOIN m x ON x.tag = a.tag JOIN m y ON y.tag = b.tag GROUP BY ALL
        """,
    ),
)
def _(t):
    return rounded(fitdays.merged_correlations(_merged(t)), "correlation")


_STORED_SCORES = f"""
    {_PAST},
    upto AS (SELECT DISTINCT greatest(CAST(timestamp AS DATE), DATE '2024-01-14') AS day FROM past),
    runs AS (SELECT day AS first, CASE WHEN day BETWEEN DATE '2024-01-15' AND DATE '2024-01-17'
        THEN DATE '2024-01-18' ELSE day END AS day FROM upto),
    m AS (SELECT runs.day, tag, avg(v) AS mean, stddev_samp(v) AS sd
        FROM (SELECT DISTINCT day FROM runs) runs JOIN past ON CAST(timestamp AS DATE) <= runs.day GROUP BY ALL),
    width AS (SELECT asset, count(*) AS d FROM features GROUP BY asset),
    old AS (SELECT past.asset, timestamp, sum(coalesce(CASE WHEN sd > 0 THEN (v - mean) / sd END, 0) ** 2) / any_value(d) AS score
        FROM past JOIN runs ON runs.first = greatest(CAST(timestamp AS DATE), DATE '2024-01-14')
        JOIN m ON m.day = runs.day AND m.tag = past.tag JOIN width ON width.asset = past.asset GROUP BY ALL),
    counts AS (SELECT asset, CAST(floor(ln(greatest(score, {fitdays.LEAST_SCORE})) / ln({fitdays.BUCKET_FACTOR}::DOUBLE)) AS BIGINT) AS bucket,
        count(*) AS n FROM old GROUP BY ALL),
    ranked AS (SELECT *, sum(n) OVER (PARTITION BY asset ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY asset) AS whole FROM counts),
    lim AS (SELECT asset, {fitdays.BUCKET_FACTOR}::DOUBLE ** (min(bucket) + 1) AS threshold, CAST(any_value(whole) AS BIGINT) AS train_bins
        FROM ranked WHERE upto >= ceil(whole * 0.99::DOUBLE) GROUP BY asset)
"""


@query(
    "fit_days_limits",
    sql(
        "telemetry features",
        f"WITH {_STORED_SCORES.strip()} SELECT asset, round(threshold, 6) AS threshold, train_bins, "
        "280 AS sliding_window FROM lim",
    ),
)
def _(t):
    model = fitdays.fit_stored(t.spark, t.features, _fit_state(t), mode="diagonal")
    return rounded(model.select("asset", "threshold", "train_bins", "sliding_window"), "threshold")


@query(
    "fit_days_score",
    sql(
        "telemetry features",
        f"""
        WITH {_STORED_SCORES.strip()},
        new AS (SELECT bins.asset, timestamp, sum(coalesce(CASE WHEN sd > 0 THEN (v - mean) / sd END, 0) ** 2) / any_value(d) AS score
            FROM bins JOIN m ON m.tag = bins.tag AND m.day = DATE '2024-01-19' JOIN width ON width.asset = bins.asset
            WHERE timestamp >= TIMESTAMP '{CUTOFF}' GROUP BY ALL)
        SELECT asset, timestamp, round(score, 6) AS score, score > threshold AS is_anomaly,
            round(CASE WHEN score > threshold THEN 1 - threshold / score ELSE 0 END, 6) AS severity
        FROM new JOIN lim USING (asset)
        """,
    ),
)
def _(t):
    model = fitdays.fit_stored(t.spark, t.features, _fit_state(t), CUTOFF, mode="diagonal")
    late = t.telemetry.filter(F.col("timestamp") >= timing.literal(CUTOFF))
    vecs = mvad.vectors(mvad.asset_frames(late, t.features, "1hour"), model)
    return rounded(mvad.mvad_score(vecs, model).drop("missing"), "score", "severity")
