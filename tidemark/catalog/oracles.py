"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

KEYS = "dataset, task, model"

PRED = """
reg AS (SELECT event_id + 1 AS instance_id, user_id, CAST(value AS DECIMAL(12,2)) AS actual,
          CAST(CASE WHEN value > 50 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS label FROM events),
ord AS (SELECT o_orderkey + 1 AS instance_id, CAST(round(o_totalprice) AS DECIMAL(12,2)) AS actual FROM orders),
pred0 AS (
  SELECT 'events' AS dataset, 'regression' AS task, 'last' AS model, instance_id,
         lag(actual) OVER (ORDER BY instance_id) AS prediction, actual FROM reg
  UNION ALL SELECT 'events', 'regression', 'last_user', instance_id,
         lag(actual) OVER (PARTITION BY user_id ORDER BY instance_id), actual FROM reg
  UNION ALL SELECT 'events', 'classification', 'last', instance_id, lag(label) OVER (ORDER BY instance_id), label FROM reg
  UNION ALL SELECT 'events', 'classification', 'last_user', instance_id,
         lag(label) OVER (PARTITION BY user_id ORDER BY instance_id), label FROM reg
  UNION ALL SELECT 'orders', 'regression', 'last', instance_id, lag(actual) OVER (ORDER BY instance_id), actual FROM ord),
pred AS (
  SELECT *, CAST(CASE WHEN prediction IS NULL THEN NULL
                      WHEN task = 'classification' THEN CASE WHEN prediction <> actual THEN 1 ELSE 0 END
                      ELSE abs(prediction - actual) END AS DECIMAL(12,2)) AS error,
         prediction IS NOT NULL AND instance_id % 2500 = 0 AS drift
  FROM pred0)"""

SEG = PRED + """,
num AS (
  SELECT *, count(prediction) OVER w AS n, count(*) FILTER (WHERE error = 0) OVER w AS n_correct,
         count(*) FILTER (WHERE drift) OVER w AS segment
  FROM pred WINDOW w AS (PARTITION BY dataset, task, model ORDER BY instance_id)),
seg AS (
  SELECT *, count(prediction) OVER (PARTITION BY dataset, task, model, segment ORDER BY instance_id) AS segment_row FROM num)"""

MET = SEG + """,
met AS (
  SELECT dataset, task, model, instance_id, n, segment, segment_row,
    CASE WHEN task = 'classification' THEN n_correct::DOUBLE / n END AS cumulative_accuracy,
    CASE WHEN task = 'classification' THEN (count(*) FILTER (WHERE error = 0) OVER s)::DOUBLE / n END AS cumulative_accuracy_as_coded,
    CASE WHEN task = 'classification' THEN (count(*) FILTER (WHERE error = 0) OVER s)::DOUBLE / segment_row END AS segment_accuracy,
    CASE WHEN task = 'classification' THEN (count(*) FILTER (WHERE error = 0) OVER r)::DOUBLE / least(n, 1000) END AS window_accuracy,
    CASE WHEN task = 'regression' THEN CAST(sum(error) FILTER (WHERE segment = 0 OR segment_row > 200) OVER s AS DOUBLE)
         / nullif(count(*) FILTER (WHERE segment = 0 OR segment_row > 200) OVER s, 0) END AS cumulative_mae,
    CASE WHEN task = 'regression' THEN CAST(sum(error * error) FILTER (WHERE segment = 0 OR segment_row > 200) OVER s AS DOUBLE)
         / nullif(count(*) FILTER (WHERE segment = 0 OR segment_row > 200) OVER s, 0) END AS cumulative_mse,
    CASE WHEN task = 'regression' THEN CAST(sum(error) OVER r AS DOUBLE) / least(n, 1000) END AS window_mae,
    CASE WHEN task = 'regression' THEN CAST(sum(error * error) OVER r AS DOUBLE) / least(n, 1000) END AS window_mse
  FROM seg WHERE prediction IS NOT NULL
  WINDOW s AS (PARTITION BY dataset, task, model, segment ORDER BY instance_id),
         r AS (PARTITION BY dataset, task, model ORDER BY instance_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)),
log AS (SELECT * RENAME (instance_id AS instance) FROM met),
perf AS (SELECT *, CASE WHEN task = 'classification' THEN cumulative_accuracy ELSE cumulative_mae END AS value FROM log),
drifts AS (SELECT dataset, task, model, instance_id AS drift_instance FROM pred WHERE drift)"""

SHIFT = MET + """,
shift0 AS (
  SELECT p.dataset, p.task, p.model, drift_instance,
    avg(value) FILTER (WHERE instance < drift_instance) AS before_mean,
    avg(value) FILTER (WHERE instance > drift_instance) AS after_mean
  FROM perf p JOIN drifts d ON p.dataset = d.dataset AND p.task = d.task AND p.model = d.model
    AND instance BETWEEN drift_instance - 500 AND drift_instance + 500 AND instance <> drift_instance
  GROUP BY ALL
  HAVING count(*) FILTER (WHERE instance < drift_instance) > 0 AND count(*) FILTER (WHERE instance > drift_instance) > 0),
shifts AS (
  SELECT dataset, task, model, drift_instance, round(before_mean, 6) AS before_mean, round(after_mean, 6) AS after_mean,
    round(after_mean - before_mean, 6) + 0.0::DOUBLE AS shift, round(abs(after_mean - before_mean), 6) AS shift_magnitude,
    CASE WHEN after_mean - before_mean < 0 THEN 'decrease' ELSE 'increase' END AS shift_type
  FROM shift0)"""

SPREAD = """,
spread0 AS (
  SELECT p.dataset, p.model, drift_instance,
    avg(cumulative_accuracy) FILTER (WHERE instance < drift_instance) AS b, avg(cumulative_accuracy) FILTER (WHERE instance > drift_instance) AS a,
    stddev_samp(cumulative_accuracy) FILTER (WHERE instance < drift_instance) AS bs,
    stddev_samp(cumulative_accuracy) FILTER (WHERE instance > drift_instance) AS sa
  FROM log p JOIN drifts d ON p.dataset = d.dataset AND p.task = d.task AND p.model = d.model AND p.task = 'classification'
    AND instance BETWEEN drift_instance - 1000 AND drift_instance + 1000 AND instance <> drift_instance
  GROUP BY ALL
  HAVING count(*) FILTER (WHERE instance < drift_instance) > 0 AND count(*) FILTER (WHERE instance > drift_instance) > 0),
spread AS (
  SELECT dataset, model, drift_instance, b AS before_mean_acc, a AS after_mean_acc, bs AS before_std, sa AS after_std,
    b - a AS accuracy_drop, sa - bs AS variance_change FROM spread0)"""

IMPACT = """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY dataset, task, model ORDER BY instance) AS r,
             count(*) OVER (PARTITION BY dataset, task, model) AS total FROM perf),
marks AS (
  SELECT d.dataset, d.task, d.model, drift_instance, max(r) FILTER (WHERE instance < drift_instance) AS rb,
    min(r) FILTER (WHERE instance > drift_instance) AS ra, max(total) AS total
  FROM ranked p JOIN drifts d ON p.dataset = d.dataset AND p.task = d.task AND p.model = d.model
  GROUP BY ALL HAVING rb IS NOT NULL AND ra IS NOT NULL),
impact AS (
  SELECT m.dataset, m.task, m.model, drift_instance, b.value AS before_performance, a.value AS immediate_after_performance,
    c.value AS recovery_performance,
    CASE WHEN m.task = 'classification' THEN b.value - a.value ELSE a.value - b.value END AS immediate_drop,
    CASE WHEN m.task = 'classification' THEN c.value - a.value ELSE a.value - c.value END AS recovery_amount,
    least(ra + 499, m.total) - ra + 1 AS recovery_time, c.instance - drift_instance AS recovery_instances
  FROM marks m
  JOIN ranked b ON b.dataset = m.dataset AND b.task = m.task AND b.model = m.model AND b.r = rb
  JOIN ranked a ON a.dataset = m.dataset AND a.task = m.task AND a.model = m.model AND a.r = ra
  JOIN ranked c ON c.dataset = m.dataset AND c.task = m.task AND c.model = m.model AND c.r = least(ra + 499, m.total))"""

LATEST = MET + """,
latest AS (
  SELECT dataset, task, model, max(instance) AS instance,
    arg_max(cumulative_accuracy, instance) AS cumulative_accuracy, arg_max(window_accuracy, instance) AS window_accuracy,
    arg_max(cumulative_mae, instance) AS cumulative_mae, arg_max(cumulative_mse, instance) AS cumulative_mse,
    arg_max(window_mae, instance) AS window_mae, arg_max(window_mse, instance) AS window_mse
  FROM log GROUP BY ALL)"""

SUMMARY = MET + """,
summary AS (
  SELECT p.dataset, p.task, p.model, count(p.prediction) AS total_instances, count(*) FILTER (WHERE p.drift) AS drift_events,
    min(p.instance_id) FILTER (WHERE p.drift) AS first_drift FROM pred p GROUP BY ALL),
final AS (SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY dataset, task, model ORDER BY instance_id DESC) = 1),
runs AS (SELECT s.*, f.* EXCLUDE (dataset, task, model, instance_id, n, segment, segment_row)
         FROM summary s JOIN final f USING (dataset, task, model))"""

FEATURES = """
  SELECT event_id + 1 AS instance_id, user_id, event_type, value,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS x1, hour(ts) / 24.0::DOUBLE AS x2 FROM events"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip().lstrip(',')} {select}"


SCORES = """
cells AS (SELECT {keys}, actual::INT AS a, prediction::INT AS p, count(*) AS c FROM {source} WHERE prediction IS NOT NULL GROUP BY ALL),
classes AS (SELECT {keys}, a AS class FROM cells UNION SELECT {keys}, p FROM cells),
per AS (
  SELECT k.*, coalesce((SELECT sum(c) FROM cells x WHERE {same} AND x.a = k.class), 0)::BIGINT AS support,
    coalesce((SELECT sum(c) FROM cells x WHERE {same} AND x.p = k.class), 0)::BIGINT AS predicted,
    coalesce((SELECT sum(c) FROM cells x WHERE {same} AND x.p = k.class AND x.a = k.class), 0)::BIGINT AS hits FROM classes k),
tot AS (SELECT {keys}, sum(support)::BIGINT AS n, sum(hits)::BIGINT AS h, sum(support * predicted)::HUGEINT AS chance FROM per GROUP BY ALL)
SELECT {pkeys}, class, support, h::DOUBLE / n AS accuracy,
  CASE WHEN n::HUGEINT * n - chance <> 0 THEN (n::HUGEINT * h - chance)::DOUBLE / (n::HUGEINT * n - chance)::DOUBLE END AS kappa,
  CASE WHEN predicted > 0 THEN hits::DOUBLE / predicted END AS precision,
  CASE WHEN support > 0 THEN hits::DOUBLE / support END AS recall,
  2 * hits::DOUBLE / (support + predicted) AS f1
FROM per p JOIN tot USING ({keys})"""


def linear_sql(task: str, loss: str, rate: str) -> str:
    """Recursive run of one linear learner per user."""
    y = "CASE WHEN value > 50 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" if task == "classification" else "value"
    score = "(r.w1 * k.x1 + r.w2 * k.x2 + r.b)"
    sign = "(CASE WHEN k.y > 0.5 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END)"

    def step(score: str) -> str:
        if loss == "squared":
            return f"-({rate}) * ({score} - k.y)"
        if loss == "hinge":
            return f"CASE WHEN {sign} * {score} < 1 THEN ({rate}) * {sign} ELSE 0.0::DOUBLE END"
        if loss == "perceptron":
            return f"CASE WHEN {sign} * {score} <= 0 THEN ({rate}) * {sign} ELSE 0.0::DOUBLE END"
        norm = "(1.0::DOUBLE + k.x1 * k.x1 + k.x2 * k.x2)"
        return f"{sign} * least(1.0::DOUBLE, greatest(0.0::DOUBLE, 1.0::DOUBLE - {sign} * {score}) / {norm})"

    shown = score if task == "regression" else f"CASE WHEN {score} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    first, later = step("0.0::DOUBLE"), step(score)
    return f"""RECURSIVE k AS (
  SELECT f.*, ({y})::DOUBLE AS y, row_number() OVER (PARTITION BY user_id ORDER BY instance_id) AS t FROM ({FEATURES}) f),
r AS (
  SELECT user_id, instance_id, t, NULL::DOUBLE AS prediction, y,
    (({first}) * x1)::DOUBLE AS w1, (({first}) * x2)::DOUBLE AS w2, ({first})::DOUBLE AS b FROM k WHERE t = 1
  UNION ALL
  SELECT k.user_id, k.instance_id, k.t, ({shown})::DOUBLE, k.y,
    r.w1 + ({later}) * k.x1, r.w2 + ({later}) * k.x2, r.b + ({later})
  FROM r JOIN k ON k.user_id = r.user_id AND k.t = r.t + 1),
run AS (SELECT user_id, instance_id, prediction,
  {"abs(prediction - y)" if task == "regression" else "CASE WHEN prediction <> y THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"} AS e FROM r)"""


INVERSE = "0.01::DOUBLE / pow(k.t, 0.25::DOUBLE)"
LINEAR = {
    "sgd_regress_keyed": ("regression", "squared", INVERSE),
    "sgd_toy_keyed": ("regression", "squared", "0.0001::DOUBLE"),
    "sgd_classify_keyed": ("classification", "hinge", INVERSE),
    "perceptron_keyed": ("classification", "perceptron", "1.0::DOUBLE"),
    "pa_keyed": ("classification", "passive_aggressive", "0.0"),
}


def _linear(name: str) -> str:
    return (
        f"WITH {linear_sql(*LINEAR[name])} SELECT user_id, instance_id, round(prediction, 6) + 0.0::DOUBLE AS prediction, "
        "round(CASE WHEN prediction IS NOT NULL THEN e END, 6) AS error FROM run"
    )


def _knn(regression: bool) -> str:
    features = "v.embedding[2:64]" if regression else "v.embedding"
    other = features.replace("v.", "m.")
    actual = "round(embedding[1]::DOUBLE * 1000) + 0.0::DOUBLE" if regression else "label::DOUBLE"
    answer = (
        "SELECT id, avg(y) AS prediction FROM near GROUP BY id"
        if regression
        else "SELECT id, y AS prediction FROM (SELECT id, y, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, y) AS q "
        "FROM near GROUP BY id, y) WHERE q = 1"
    )
    return f"""WITH v AS (SELECT vec_id + 1 AS id, embedding::DOUBLE[] AS embedding, {actual} AS y FROM embeddings),
near AS (SELECT id, y FROM (
  SELECT v.id, m.y, row_number() OVER (PARTITION BY v.id ORDER BY list_distance({features}, {other}), m.id) AS q
  FROM v JOIN v m ON m.id < v.id AND m.id >= v.id - 100) WHERE q <= 5),
vote AS ({answer})
SELECT v.id AS instance_id, prediction, v.y AS actual FROM v LEFT JOIN vote USING (id)"""


def _tidy(section: str, model: str, source: str, group: str, metrics: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {model} AS model, '{name}' AS metric, round(({sql})::DOUBLE, 4) + 0.0::DOUBLE AS value FROM {source} {group}"
        for name, sql in metrics.items()
    )


IMPACT_FIGURES = {
    "average_immediate_drop": "avg(immediate_drop)",
    "average_recovery_amount": "avg(recovery_amount)",
    "average_recovery_time": "avg(recovery_time)",
}
REPORT = " UNION ALL ".join(
    [
        _tidy(
            "summary",
            "'all'",
            "drifts",
            "",
            {
                "total_drift_events": "count(*)",
                "datasets": "count(DISTINCT dataset)",
                "models": "count(DISTINCT model)",
                "tasks": "count(DISTINCT task)",
            },
        ),
        _tidy(
            "mean_shift",
            "'all'",
            "shift0",
            "",
            {
                "average_shift": "avg(abs(after_mean - before_mean))",
                "max_shift": "max(abs(after_mean - before_mean))",
                "min_shift": "min(abs(after_mean - before_mean))",
            },
        ),
        _tidy(
            "mean_shift_by_model",
            "model",
            "shift0",
            "GROUP BY model",
            {
                "average_shift": "avg(abs(after_mean - before_mean))",
                "std_shift": "stddev_samp(abs(after_mean - before_mean))",
            },
        ),
        _tidy("impact", "model", "impact", "GROUP BY model", IMPACT_FIGURES),
        _tidy("impact", "'all'", "impact", "", IMPACT_FIGURES),
        _tidy(
            "class_imbalance",
            "'all'",
            "spread",
            "",
            {"average_accuracy_drop": "avg(accuracy_drop)", "average_variance_change": "avg(variance_change)"},
        ),
    ]
)
MODEL_NAMES = "['hoeffding_tree','arf','knn','sgd','passive_aggressive','perceptron','fimtdd','lstm']"
SERVED = (
    "('classification','sgd'),('classification','perceptron'),('classification','passive_aggressive'),"
    "('classification','knn'),('classification','hoeffding_tree'),('classification','arf'),"
    "('regression','sgd'),('regression','knn'),('regression','fimtdd'),('regression','arf')"
)


def _multi() -> str:
    parts = []
    for name, (task, loss, rate) in LINEAR.items():
        model = {
            "sgd_regress_keyed": "sgd",
            "sgd_toy_keyed": "sgd_toy",
            "sgd_classify_keyed": "sgd",
            "perceptron_keyed": "perceptron",
            "pa_keyed": "passive_aggressive",
        }[name]
        parts.append(
            f"SELECT * FROM (WITH {linear_sql(task, loss, rate)} SELECT '{task}' AS task, '{model}' AS model, "
            "count(*) AS evaluated, round(avg(e), 4) AS mean_error FROM run WHERE prediction IS NOT NULL)"
        )
    return " UNION ALL ".join(parts)


def _normalize(source: str, columns: str) -> str:
    return f"""
    SELECT *, min(x) OVER w AS lo, max(x) OVER w AS hi, row_number() OVER w AS n
    FROM ({source}) WINDOW w AS (PARTITION BY {columns} ORDER BY instance_id)"""


SCALED = "CASE WHEN n < 100 THEN x WHEN hi = lo THEN x - lo ELSE (x - lo) / (hi - lo) END"
LOGGED = "cumulative_accuracy, window_accuracy, cumulative_mae, cumulative_mse, window_mae"

RATES = """WITH s AS (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS "at", max(event_id) AS instances FROM events GROUP BY ALL),
      l AS (SELECT *, instances - lag(instances) OVER w AS g, (epoch_us("at") - lag(epoch_us("at")) OVER w) / 1e6::DOUBLE AS sec FROM s
        WINDOW w AS (PARTITION BY event_type ORDER BY "at"))
      SELECT event_type, "at", instances, CASE WHEN g > 0 AND sec > 0 THEN g / sec ELSE 0.0::DOUBLE END AS rate FROM l"""


ORACLES: dict[str, str] = {
    "inject_label_swap": """SELECT event_id + 1 AS instance_id,
      (CASE WHEN (value > 50) = (event_id + 1 < 4000) THEN 1 ELSE 0 END)::INT AS label, event_id + 1 >= 4000 AS drift_injected FROM events""",
    "inject_target_scale": """SELECT event_id + 1 AS instance_id, CASE WHEN event_id + 1 >= 4000 THEN value * 2.0::DOUBLE ELSE value END AS target,
      event_id + 1 >= 4000 AS drift_injected FROM events""",
    "encode_decode_roundtrip": f"""WITH f AS ({FEATURES})
      SELECT 'events' AS dataset, 'classification' AS task, instance_id, x1, x2,
        (CASE WHEN (value > 50) = (instance_id < 4000) THEN 1 ELSE 0 END)::DOUBLE AS actual, instance_id >= 4000 AS drift_injected FROM f
      UNION ALL SELECT 'events', 'regression', instance_id, x1, x2,
        CASE WHEN instance_id >= 4000 THEN value * 2.0::DOUBLE ELSE value END, instance_id >= 4000 FROM f""",
    "running_minmax_normalize": f"""WITH f AS ({FEATURES}),
      l AS (SELECT instance_id, 1 AS i, x1 AS x FROM f UNION ALL SELECT instance_id, 2, x2 FROM f),
      s AS (SELECT instance_id, i, {SCALED} AS z FROM ({_normalize('SELECT * FROM l', 'i')}))
      SELECT instance_id, max(z) FILTER (WHERE i = 1) AS x1, max(z) FILTER (WHERE i = 2) AS x2 FROM s GROUP BY instance_id""",
    "normalize_wide": f"""WITH l AS (SELECT vec_id + 1 AS instance_id, (unnest(range(64)))::INT AS feature, unnest(embedding)::DOUBLE AS x FROM embeddings)
      SELECT instance_id, feature, {SCALED} AS value FROM ({_normalize('SELECT * FROM l', 'feature')})""",
    "running_mean_m2": """SELECT instance_id, n, s / n AS running_mean, q - s * s / n AS running_m2 FROM (
      SELECT event_id + 1 AS instance_id, count(*) OVER w AS n, (sum(c) OVER w)::DOUBLE AS s, (sum(c * c) OVER w)::DOUBLE AS q
      FROM (SELECT event_id, round(value * 100)::BIGINT AS c FROM events) WINDOW w AS (ORDER BY event_id))""",
    "preq_reg_segment_metrics": with_(MET, f"SELECT {KEYS}, instance_id, n, segment, cumulative_mae, cumulative_mse, window_mae, window_mse FROM met WHERE task = 'regression'"),
    "sparse_prefix_metrics": with_(MET, f"SELECT {KEYS}, instance_id * 1000000000 AS instance_id, n, segment, cumulative_mae, cumulative_mse, window_mae, window_mse FROM met WHERE task = 'regression'"),
    "preq_cls_segment_metrics": with_(
        MET,
        f"SELECT {KEYS}, instance_id, n, segment, cumulative_accuracy, cumulative_accuracy_as_coded, segment_accuracy, window_accuracy FROM met WHERE task = 'classification'",
    ),
    "preq_keyed_metrics": """WITH p AS (
        SELECT user_id, event_id + 1 AS instance_id, event_type, CAST(value AS DECIMAL(12,2)) AS actual,
          lag(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY event_id) AS prediction FROM events),
      e AS (SELECT *, abs(prediction - actual) AS error, prediction IS NOT NULL AND event_type = 'error' AS drift FROM p),
      s AS (SELECT *, count(prediction) OVER w AS n, count(*) FILTER (WHERE drift) OVER w AS segment FROM e
        WINDOW w AS (PARTITION BY user_id ORDER BY instance_id)),
      g AS (SELECT *, count(prediction) OVER (PARTITION BY user_id, segment ORDER BY instance_id) AS segment_row FROM s)
      SELECT user_id, instance_id, n, segment, segment_row,
        CAST(sum(error) FILTER (WHERE segment = 0 OR segment_row > 5) OVER c AS DOUBLE)
          / nullif(count(*) FILTER (WHERE segment = 0 OR segment_row > 5) OVER c, 0) AS cumulative_mae,
        CAST(sum(error) OVER r AS DOUBLE) / least(n, 20) AS window_mae,
        CAST(sum(error * error) OVER r AS DOUBLE) / least(n, 20) AS window_mse
      FROM g WHERE prediction IS NOT NULL
      WINDOW c AS (PARTITION BY user_id, segment ORDER BY instance_id),
             r AS (PARTITION BY user_id ORDER BY instance_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "prediction_diversity": with_(
        SEG,
        f"""SELECT {KEYS}, instance_id, n, list_unique(list(prediction) OVER r)::BIGINT AS unique_predictions, list_unique(list(actual) OVER r)::BIGINT AS unique_actuals
        FROM num WHERE prediction IS NOT NULL
        WINDOW r AS (PARTITION BY {KEYS} ORDER BY instance_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)""",
    ),
    "metrics_log_periodic": with_(MET, f"SELECT {KEYS}, instance, {LOGGED} FROM log WHERE instance % 1000 = 0"),
    "metrics_log_timed": with_(
        MET
        + """,
timed AS (
  SELECT m.*, m.instance_id AS instance, row_number() OVER (PARTITION BY dataset, task, model, epoch_us(ts) // 3600000000 ORDER BY instance_id) AS place
  FROM met m JOIN events e ON e.event_id + 1 = m.instance_id)""",
        f"SELECT {KEYS}, instance, {LOGGED} FROM timed WHERE place = 1 OR instance % 1000 = 0",
    ),
    "preq_run_summary": with_(
        SUMMARY,
        f"SELECT {KEYS}, total_instances, drift_events, first_drift, CASE WHEN drift_events > 0 THEN drift_events::INT END AS listed_drifts, {LOGGED}, window_mse FROM runs",
    ),
    "segment_assign": with_(SEG, f"SELECT {KEYS}, instance_id, n, n_correct, segment, segment_row FROM seg"),
    "rows_since_drift": with_(
        PRED,
        f"""SELECT {KEYS}, instance_id, instance_id - max(CASE WHEN drift THEN instance_id END) OVER (
        PARTITION BY {KEYS} ORDER BY instance_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rows_since_drift FROM pred""",
    ),
    "confusion_kappa": with_(
        PRED + ", cls AS (SELECT * FROM pred WHERE task = 'classification'), "
        + SCORES.format(
            keys=KEYS,
            pkeys="p.dataset, p.task, p.model",
            source="cls",
            same="x.dataset = k.dataset AND x.task = k.task AND x.model = k.model",
        ).split("SELECT p.dataset", 1)[0],
        "SELECT p.dataset"
        + SCORES.format(
            keys=KEYS,
            pkeys="p.dataset, p.task, p.model",
            source="cls",
            same="x.dataset = k.dataset AND x.task = k.task AND x.model = k.model",
        ).split("SELECT p.dataset", 1)[1],
    ),
    "label_scores": "WITH docs AS (SELECT source, quality AS actual, CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END AS prediction FROM labels JOIN documents USING (doc_id)), "
    + SCORES.format(keys="source", pkeys="p.source", source="docs", same="x.source = k.source"),
    "regression_scores": with_(
        PRED + f""", m AS (SELECT {KEYS}, count(*) AS rows, sum(error)::DOUBLE AS se, sum(error * error)::DOUBLE AS sq,
          sum(actual)::DOUBLE AS sy, sum(actual * actual)::DOUBLE AS syy FROM pred WHERE task = 'regression' AND prediction IS NOT NULL GROUP BY ALL)""",
        f"SELECT {KEYS}, rows, round(se / rows, 4) AS mae, round(sq / rows, 4) AS mse, round(sqrt(sq / rows), 4) AS rmse, round(1 - sq / (syy - sy * sy / rows), 4) AS r2 FROM m",
    ),
    "halo_equals_global": """SELECT event_id + 1 AS instance_id, count(*) OVER w AS n, (sum(c) OVER w)::BIGINT AS total, min(c) OVER w AS low, max(c) OVER w AS high,
        (sum(c) OVER (ORDER BY event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW))::BIGINT AS last_1000
      FROM (SELECT event_id, round(value * 100)::BIGINT AS c FROM events) WINDOW w AS (ORDER BY event_id)""",
    "drift_gate": """WITH RECURSIVE a AS (SELECT event_id + 1 AS id FROM events WHERE event_type = 'error'),
      g AS (SELECT min(id) AS id FROM a WHERE id > 100 AND id >= 2000
        UNION ALL SELECT (SELECT min(a.id) FROM a WHERE a.id >= g.id + 2000) FROM g WHERE g.id IS NOT NULL)
      SELECT 'events' AS dataset, id AS instance_id, id IN (SELECT id FROM g WHERE id IS NOT NULL) AS accepted FROM a""",
    "drift_detection_delay": with_(
        PRED,
        f"""SELECT {KEYS}, min(CASE WHEN drift AND instance_id >= 4000 THEN instance_id END) - 4000 AS detection_delay,
        count(*) FILTER (WHERE drift AND instance_id < 4000) AS false_alarms, count(*) FILTER (WHERE drift) AS alarms
        FROM pred GROUP BY ALL""",
    ),
    "knn_classify": _knn(False),
    "knn_regress": _knn(True),
    "sgd_stream_blocked": f"""WITH RECURSIVE k AS (SELECT f.*, row_number() OVER (PARTITION BY event_type ORDER BY instance_id) AS t FROM ({FEATURES}) f),
      r AS (SELECT event_type, instance_id, t, NULL::DOUBLE AS prediction, 0.01::DOUBLE * value * x1 AS w1, 0.01::DOUBLE * value * x2 AS w2, 0.01::DOUBLE * value AS b FROM k WHERE t = 1
        UNION ALL SELECT k.event_type, k.instance_id, k.t, r.w1 * k.x1 + r.w2 * k.x2 + r.b,
          r.w1 - {INVERSE} * (r.w1 * k.x1 + r.w2 * k.x2 + r.b - k.value) * k.x1,
          r.w2 - {INVERSE} * (r.w1 * k.x1 + r.w2 * k.x2 + r.b - k.value) * k.x2,
          r.b - {INVERSE} * (r.w1 * k.x1 + r.w2 * k.x2 + r.b - k.value)
        FROM r JOIN k ON k.event_type = r.event_type AND k.t = r.t + 1)
      SELECT event_type, instance_id, round(prediction, 6) + 0.0::DOUBLE AS prediction FROM r""",
    "split_statistics": """WITH l AS (SELECT label AS cls, (unnest(range(64)))::INT AS f, unnest(embedding)::DOUBLE AS x FROM embeddings),
      c AS (SELECT f, least(greatest(floor((x + 1) / 2 * 16), 0), 15)::INT AS bin, cls, count(*)::DOUBLE AS w FROM l GROUP BY ALL),
      s AS (SELECT k.f, k.cut, c.cls, coalesce(sum(w) FILTER (WHERE bin <= k.cut), 0) AS a, coalesce(sum(w) FILTER (WHERE bin > k.cut), 0) AS b
            FROM (SELECT DISTINCT f, unnest(range(15))::INT AS cut FROM c) k JOIN c ON c.f = k.f GROUP BY ALL),
      n AS (SELECT f, cut, sum(a) AS an, sum(b) AS bn FROM s GROUP BY ALL HAVING sum(a) > 0 AND sum(b) > 0),
      g AS (SELECT n.f, n.cut, an + bn AS n, round(
          sum(CASE WHEN a + b > 0 THEN -(a + b) / (an + bn) * log2((a + b) / (an + bn)) ELSE 0 END)
          - an / (an + bn) * sum(CASE WHEN a > 0 THEN -a / an * log2(a / an) ELSE 0 END)
          - bn / (an + bn) * sum(CASE WHEN b > 0 THEN -b / bn * log2(b / bn) ELSE 0 END), 9) AS gain
        FROM n JOIN s ON s.f = n.f AND s.cut = n.cut GROUP BY n.f, n.cut, an, bn)
      SELECT f, n, cut, gain FROM g QUALIFY row_number() OVER (PARTITION BY f ORDER BY gain DESC, cut) = 1""",
    "multi_learner_compare": _multi(),
    "mean_shift": with_(SHIFT, "SELECT * FROM shifts"),
    "accuracy_variance": with_(
        MET + SPREAD,
        "SELECT dataset, model, drift_instance, "
        + ", ".join(
            f"round({c}, 6) + 0.0::DOUBLE AS {c}"
            for c in ("before_mean_acc", "after_mean_acc", "before_std", "after_std", "accuracy_drop", "variance_change")
        )
        + " FROM spread",
    ),
    "class_ratio": with_(
        PRED + ", d AS (SELECT DISTINCT dataset, task, instance_id AS drift_instance FROM pred WHERE drift AND task = 'classification'), r AS (SELECT instance_id AS i, label::INT AS l FROM reg)",
        """SELECT dataset, task, drift_instance, avg(l) FILTER (WHERE i < drift_instance) AS before_ratio, avg(l) FILTER (WHERE i > drift_instance) AS after_ratio
        FROM d JOIN r ON i BETWEEN drift_instance - 1000 AND drift_instance + 1000 AND i <> drift_instance GROUP BY ALL""",
    ),
    "drift_impact": with_(
        MET + IMPACT,
        f"SELECT {KEYS}, drift_instance, "
        + ", ".join(
            f"round({c}, 6) + 0.0::DOUBLE AS {c}"
            for c in (
                "before_performance",
                "immediate_after_performance",
                "recovery_performance",
                "immediate_drop",
                "recovery_amount",
            )
        )
        + ", recovery_time, recovery_instances FROM impact",
    ),
    "drift_report": with_(SHIFT + SPREAD + IMPACT, REPORT),
    "shift_boxstats": with_(
        SHIFT
        + """, q AS (SELECT model, quantile_cont(shift_magnitude, 0.25) AS q1, quantile_cont(shift_magnitude, 0.5) AS median,
          quantile_cont(shift_magnitude, 0.75) AS q3 FROM shifts GROUP BY model)""",
        """SELECT s.model, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
          round(min(shift_magnitude) FILTER (WHERE inside), 4) AS low_whisker, round(max(shift_magnitude) FILTER (WHERE inside), 4) AS high_whisker,
          count(*) FILTER (WHERE NOT inside) AS outliers
        FROM (SELECT s.model, shift_magnitude, q1, median, q3, shift_magnitude BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
              FROM shifts s JOIN q ON q.model = s.model) s GROUP BY ALL""",
    ),
    "shift_histogram": with_(
        SHIFT + ", b AS (SELECT min(shift) AS lo, max(shift) AS hi FROM shifts)",
        """SELECT model, (CASE WHEN hi = lo THEN 1 ELSE least(floor((shift - lo) / (hi - lo) * 10) + 1, 10) END)::INT AS bin, count(*) AS rows
        FROM shifts, b WHERE shift IS NOT NULL GROUP BY ALL""",
    ),
    "shift_bounds": with_(SHIFT, "SELECT least(min(before_mean), min(after_mean)) AS low, greatest(max(before_mean), max(after_mean)) AS high FROM shifts"),
    "drift_timeline": with_(MET, f"SELECT {KEYS}, drift_instance AS instance FROM drifts"),
    "drift_gaps": with_(
        MET, f"SELECT {KEYS}, drift_instance AS instance_id, drift_instance - lag(drift_instance) OVER (PARTITION BY {KEYS} ORDER BY drift_instance) AS gap FROM drifts"
    ),
    "metric_trajectory": with_(
        MET,
        """SELECT p.dataset, p.task, p.model, instance, value AS metric, drift_instance IS NOT NULL AS is_drift
        FROM perf p LEFT JOIN drifts d ON p.dataset = d.dataset AND p.task = d.task AND p.model = d.model AND instance = drift_instance""",
    ),
    "series_cumulative": with_(MET, f"SELECT {KEYS}, instance, value FROM perf WHERE dataset = 'events' AND value IS NOT NULL"),
    "series_rolling": with_(MET, f"SELECT {KEYS}, instance, window_mae AS value FROM log WHERE task = 'regression' AND model = 'last' AND window_mae IS NOT NULL"),
    "latest_metrics": with_(LATEST, "SELECT * FROM latest"),
    "latest_table": with_(
        LATEST,
        f"SELECT {KEYS}, instance, "
        + ", ".join(
            f"coalesce(printf('%.4f', {c}), 'N/A') AS {c}"
            for c in ("cumulative_accuracy", "window_accuracy", "cumulative_mae", "cumulative_mse", "window_mae", "window_mse")
        )
        + " FROM latest",
    ),
    "best_model": with_(
        LATEST,
        """SELECT dataset, task, model, v AS value FROM (
          SELECT *, CASE WHEN task = 'classification' THEN cumulative_accuracy ELSE cumulative_mae END AS v FROM latest) WHERE v IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY dataset, task ORDER BY CASE WHEN task = 'classification' THEN -v ELSE v END, model) = 1""",
    ),
    "run_comparison": with_(SUMMARY, f"SELECT {KEYS}, total_instances, drift_events, {LOGGED} FROM runs"),
    "live_stats": with_(
        LATEST + f", rates AS ({RATES})",
        """SELECT max(instance) AS max_instance, sum(instance)::BIGINT AS total_instances,
          round(avg(cumulative_accuracy) FILTER (WHERE task = 'classification'), 9) AS average_accuracy,
          count(DISTINCT model) AS active_models, (SELECT count(*) FROM drifts) AS drift_events,
          (SELECT round(sum(rate), 9) FROM (SELECT arg_max(rate, "at") AS rate FROM rates GROUP BY event_type)) AS processing_rate
        FROM latest""",
    ),
    "processing_rate": RATES,
    "first_models": with_(MET + IMPACT, "SELECT model, min(drift_instance) AS first_seen FROM impact GROUP BY model ORDER BY first_seen, model LIMIT 3"),
    "distinct_lists": with_(
        MET,
        "SELECT DISTINCT 'dataset' AS kind, dataset AS value FROM log UNION SELECT 'task', task FROM log UNION SELECT 'model', model FROM log",
    ),
    "formatted_names": """SELECT event_id, 'events' AS dataset, upper(event_type[1]) || event_type[2:] AS task, 'user_' || user_id AS model,
        'stream-' || event_type AS topic, format('{:,}', event_id) AS shown_id,
        CASE WHEN event_type = 'error' THEN NULL ELSE value END AS parsed,
        (epoch_us(ts) - epoch_us(date_trunc('day', ts)::TIMESTAMP)) / 1e6::DOUBLE AS second_of_day FROM events""",
    "log_scan_union": with_(MET, f"SELECT {KEYS}, instance, {LOGGED} FROM log"),
    "summary_scan_events": with_(MET, f"SELECT {KEYS}, drift_instance AS instance_id, 'ADWIN' AS detector FROM drifts"),
    "model_task_check": f"""WITH q AS (SELECT event_type AS dataset, CASE WHEN user_id % 2 = 0 THEN 'classification' ELSE 'regression' END AS task,
        {MODEL_NAMES}[event_id % 8 + 1] AS model FROM events)
      SELECT dataset, task, model, count(*) AS requests FROM q WHERE (task, model) NOT IN (VALUES {SERVED}) GROUP BY ALL""",
    "experiment_matrix": """WITH m(dataset, task, model) AS (VALUES ('electricity','classification','hoeffding_tree'),('electricity','classification','arf'),
        ('electricity','classification','knn'),('bike','regression','fimtdd'),('bike','regression','arf'),('bike','regression','knn'))
      SELECT dataset, task, model, count(*) AS instances, max(event_id) + 1 AS last_instance FROM events, m GROUP BY ALL""",
    "stream_preq_metrics": with_(
        MET,
        f"""SELECT {KEYS}, instance, n, segment, cumulative_accuracy, window_accuracy, cumulative_mae, window_mae
        FROM log WHERE dataset = 'events' AND model = 'last' AND instance % 1000 = 0""",
    ),
}


CHUNKS = 5  # enough for the 10,000 rows that the oracle runs on


def _chunked(loss: str) -> str:
    """Doubling chunks of one stream, the weights moving between chunks by the mean step."""
    chunk = "CASE " + " ".join(f"WHEN n <= {1250 << i} THEN {i}" for i in range(CHUNKS)) + " END"
    sign = "(CASE WHEN y > 0.5 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END)"
    score = "(coalesce(w1, 0) * x1 + coalesce(w2, 0) * x2 + coalesce(b, 0))"
    step = (
        f"CASE WHEN {sign} * {score} < 1 THEN 0.5::DOUBLE * {sign} ELSE 0.0::DOUBLE END"
        if loss == "hinge"
        else f"{sign} * least(1.0::DOUBLE, greatest(0.0::DOUBLE, 1.0::DOUBLE - {sign} * {score}) / (1.0::DOUBLE + x1 * x1 + x2 * x2))"
    )
    ctes = [
        f"k AS (SELECT instance_id, x1, x2, CASE WHEN value > 50 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y, "
        f"{chunk} AS chunk FROM (SELECT *, row_number() OVER (ORDER BY instance_id) AS n FROM ({FEATURES})))",
        "m0 AS (SELECT NULL::DOUBLE AS w1, NULL::DOUBLE AS w2, NULL::DOUBLE AS b)",
    ]
    for i in range(CHUNKS - 1):
        ctes.append(
            f"m{i + 1} AS (SELECT coalesce(max(w1), 0) + avg(({step}) * x1) AS w1, coalesce(max(w2), 0) + avg(({step}) * x2) AS w2, "
            f"coalesce(max(b), 0) + avg({step}) AS b FROM k, m{i} WHERE chunk = {i})"
        )
    parts = " UNION ALL ".join(
        f"SELECT 'events' AS dataset, 'classification' AS task, instance_id, CASE WHEN w1 IS NULL THEN NULL "
        f"WHEN w1 * x1 + w2 * x2 + b > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, y AS actual FROM k, m{i} WHERE chunk = {i}"
        for i in range(CHUNKS)
    )
    return "WITH " + ", ".join(ctes) + " " + parts


ORACLES |= {name: _linear(name) for name in LINEAR}
ORACLES |= {"pa_chunked": _chunked("passive_aggressive"), "sgd_classify_chunked": _chunked("hinge")}


def _multiclass() -> str:
    """One model per class, row by row: a list of ten weight lists moves through each stream."""
    score = "list_inner_product(w[c], z)"
    sign = "(CASE WHEN k.y = c - 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END)"
    steps = {
        "sgd": f"CASE WHEN {sign} * {score} < 1 THEN 0.01::DOUBLE / pow(t, 0.25) * {sign} ELSE 0.0::DOUBLE END",
        "perceptron": f"CASE WHEN {sign} * {score} <= 0 THEN {sign} ELSE 0.0::DOUBLE END",
        "passive_aggressive": f"{sign} * least(1.0::DOUBLE, greatest(0.0::DOUBLE, 1.0::DOUBLE - {sign} * {score}) / list_inner_product(z, z))",
    }
    ctes = [
        "k AS (SELECT (vec_id + 1) % 4 AS stream, vec_id + 1 AS instance_id, label AS y, "
        "list_append(list_transform(embedding, lambda v: v::DOUBLE), 1.0::DOUBLE) AS z, "
        "row_number() OVER (PARTITION BY (vec_id + 1) % 4 ORDER BY vec_id) AS t FROM embeddings)"
    ]
    for name, step in steps.items():
        ctes.append(
            f"{name} AS (SELECT DISTINCT stream, 0::BIGINT AS t, NULL::BIGINT AS instance_id, NULL::INT AS y, NULL::BIGINT AS guess, "
            "list_transform(range(1, 11), lambda c: list_transform(range(1, 66), lambda j: 0.0::DOUBLE)) AS w FROM k "
            "UNION ALL SELECT stream, t, instance_id, y, "
            "CASE WHEN t > 1 THEN list_position(scores, list_max(scores)) - 1 END, "
            "list_transform(range(1, 11), lambda c: list_transform(range(1, 66), lambda j: w[c][j] + steps[c] * z[j])) "
            f"FROM (SELECT k.stream, k.t, k.instance_id, k.y, k.z, r.w, list_transform(range(1, 11), lambda c: {score}) AS scores, "
            f"list_transform(range(1, 11), lambda c: {step.replace('pow(t,', 'pow(k.t,')}) AS steps "
            f"FROM {name} r JOIN k ON k.stream = r.stream AND k.t = r.t + 1))"
        )
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS model, stream, instance_id, guess::DOUBLE AS prediction, "
        f"CASE WHEN guess IS NOT NULL THEN (guess <> y)::INT::DOUBLE END AS error FROM {name} WHERE t > 0"
        for name in steps
    )
    return "WITH RECURSIVE " + ", ".join(ctes) + " " + parts


ORACLES["multiclass_linear"] = _multiclass()


def _adwin(source: str, keys: str, grain: int = 1, cooldown: int = 2000, min_rows: int = 100, alarms: bool = True) -> str:
    """The detector row by row: ``source`` gives keys, instance_id, t (1, 2, ...), n, s and q of each insertion.

    The histogram is three lists (values, sum and squared deviations of each bucket, oldest first). A step either inserts or,
    while ``pending``, looks for a further cut after the oldest bucket was dropped.
    """
    names = keys.split(", ")
    same = " AND ".join(f"v.{k} = r.{k}" for k in names)
    empty = "[]::BIGINT[] AS z, []::DOUBLE[] AS s, []::DOUBLE[] AS q, 0.0::DOUBLE AS total, 0.0::DOUBLE AS m2"
    carried = f"{keys}, instance_id, t, n, last"
    fresh = "r.drift AND NOT r.pending"
    begin = f"""SELECT {', '.join('v.' + k for k in names)}, v.instance_id, v.t, v.n, r.last, r.pending AS again, v.s AS vs, v.q AS vq,
        CASE WHEN r.pending THEN r.direction ELSE 0 END AS direction, CASE WHEN {fresh} THEN 0 ELSE r.seen END AS seen,
        CASE WHEN {fresh} THEN [] ELSE r.z END AS z, CASE WHEN {fresh} THEN [] ELSE r.s END AS s, CASE WHEN {fresh} THEN [] ELSE r.q END AS q,
        CASE WHEN {fresh} THEN 0.0::DOUBLE ELSE r.total END AS total, CASE WHEN {fresh} THEN 0.0::DOUBLE ELSE r.m2 END AS m2,
        CASE WHEN {fresh} THEN 0 ELSE coalesce(list_sum(r.z), 0)::BIGINT END AS w
      FROM r JOIN v ON {same} AND v.t = r.t + CASE WHEN r.pending THEN 0 ELSE 1 END"""
    merges = (
        f"coalesce(list_min(list_filter(range(0, 40), lambda k: len(list_filter(z, lambda x: x = {grain} * (1::BIGINT << k))) <> 5)), 0)"
    )
    insert = f"""SELECT {carried}, again, direction, CASE WHEN again THEN seen ELSE seen + {grain} END AS seen,
        CASE WHEN again THEN 0 ELSE {merges} END AS r,
        CASE WHEN again THEN z ELSE list_append(z, {grain}::BIGINT) END AS z, CASE WHEN again THEN s ELSE list_append(s, vs) END AS s,
        CASE WHEN again THEN q ELSE list_append(q, vq) END AS q, CASE WHEN again THEN total ELSE total + vs END AS total,
        CASE WHEN again THEN m2 WHEN w = 0 THEN vq
             ELSE m2 + (vq + w * {grain} * pow(vs / {grain} - total / w, 2) / (w + {grain})) END AS m2 FROM ({begin})"""
    flagged = f"""SELECT *, list_transform(range(1, len(z) + 1), lambda i: z[i] < {grain} * (1::BIGINT << r) AND (i = 1 OR z[i - 1] <> z[i])) AS f
      FROM ({insert})"""
    merged = f"""SELECT {carried}, again, direction, seen, total, m2,
        list_transform(keep, lambda i: CASE WHEN f[i] THEN 2 * z[i] ELSE z[i] END) AS z,
        list_transform(keep, lambda i: CASE WHEN f[i] THEN s[i] + s[i + 1] ELSE s[i] END) AS s,
        list_transform(keep, lambda i: CASE WHEN f[i] THEN q[i] + q[i + 1] + z[i] * pow((s[i] - s[i + 1]) / z[i], 2) / 2 ELSE q[i] END) AS q
      FROM (SELECT *, list_filter(range(1, len(z) + 1), lambda i: i = 1 OR NOT f[i - 1]) AS keep FROM ({flagged}))"""
    ticked = f"""SELECT *, (again OR seen // 32 <> (seen - {grain}) // 32) AND w > 10 AS tick, ln(2 * ln(w) / 0.01::DOUBLE) AS bound
      FROM (SELECT *, list_sum(z)::BIGINT AS w FROM ({merged}))"""
    sides = f"""SELECT *, CASE WHEN tick THEN list_transform(range(1, len(z)), lambda i: list_sum(z[1:i])::DOUBLE) ELSE [] END AS n0,
        CASE WHEN tick THEN list_transform(range(1, len(z)), lambda i: list_sum(s[1:i])) ELSE [] END AS s0 FROM ({ticked})"""
    gap = "((total - s0[i]) / (w - n0[i]) - s0[i] / n0[i])"
    inverse = "(1 / n0[i] + 1 / (w - n0[i]))"
    cut = f"""SELECT *, list_filter(range(1, len(n0) + 1), lambda i: n0[i] >= 5 AND w - n0[i] >= 5 AND
        abs({gap}) > sqrt(2 * {inverse} * m2 / w * bound) + 2.0::DOUBLE / 3 * {inverse} * bound)[1] AS i FROM ({sides})"""
    found = f"SELECT *, CASE WHEN i IS NULL THEN 0 WHEN {gap} > 0 THEN 1 ELSE -1 END AS found FROM ({cut})"
    rest = "(w - z[1])"
    dropped = f"""SELECT {carried}, seen, found <> 0 AS pending, CASE WHEN found <> 0 THEN found ELSE direction END AS direction,
        CASE WHEN found <> 0 THEN z[2:] ELSE z END AS z, CASE WHEN found <> 0 THEN s[2:] ELSE s END AS s, CASE WHEN found <> 0 THEN q[2:] ELSE q END AS q,
        CASE WHEN found <> 0 THEN total - s[1] ELSE total END AS total,
        CASE WHEN found <> 0 THEN greatest(0, m2 - q[1] - z[1] * {rest} * pow(s[1] / z[1] - (total - s[1]) / {rest}, 2) / w) ELSE m2 END AS m2
      FROM ({found})"""
    gated = f"""SELECT *, NOT pending AND direction <> 0 AND n > {min_rows} AND n - last >= {cooldown} AS accepted FROM ({dropped})"""
    return f"""{source},
      r AS (SELECT DISTINCT {keys}, NULL::BIGINT AS instance_id, 0::BIGINT AS t, 0::BIGINT AS n, 0::BIGINT AS last, 0::BIGINT AS seen, false AS pending,
          0 AS direction, {empty}, false AS drift FROM v
        UNION ALL SELECT {keys}, instance_id, t, n, CASE WHEN accepted THEN n ELSE last END, seen, pending, direction, z, s, q, total, m2, accepted
        FROM ({gated}))
      SELECT {keys}, instance_id, n, direction, drift FROM r WHERE t > 0 AND NOT pending{' AND direction <> 0' if alarms else ''}"""


INJECTED = PRED.strip() + f""",
e AS (SELECT {KEYS}, instance_id, CAST(CASE WHEN instance_id > half THEN error * 3 ELSE error END AS DOUBLE) AS e,
        row_number() OVER (PARTITION BY {KEYS} ORDER BY instance_id) AS n
      FROM pred JOIN (SELECT {KEYS}, max(instance_id) / 2 AS half FROM pred GROUP BY ALL) USING ({KEYS}) WHERE error IS NOT NULL)"""
SINGLE = "n AS t, n, e AS s, 0.0::DOUBLE AS q"
ORACLES["adwin_runs"] = _adwin(f"WITH RECURSIVE {INJECTED}, v AS MATERIALIZED (SELECT {KEYS}, instance_id, {SINGLE} FROM e)", KEYS)
ORACLES["adwin_grained"] = _adwin(
    f"""WITH RECURSIVE {INJECTED}, v AS MATERIALIZED (SELECT {KEYS}, max(instance_id) AS instance_id, max(n) // 32 AS t, max(n) AS n, sum(e) AS s,
      var_pop(e) * 32 AS q FROM e GROUP BY {KEYS}, (n - 1) // 32 HAVING count(*) = 32)""",
    KEYS,
    grain=32,
)
ORACLES["adwin_keyed"] = _adwin(
    f"""WITH RECURSIVE e AS (SELECT 'events' AS dataset, 'regression' AS task, user_id, event_id + 1 AS instance_id, value::DOUBLE AS e,
      row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE value IS NOT NULL),
      v AS MATERIALIZED (SELECT dataset, task, user_id, instance_id, {SINGLE} FROM e)""",
    "dataset, task, user_id",
    cooldown=0,
    min_rows=0,
    alarms=False,
)
ORACLES["adwin_stream_blocks"] = _adwin(
    f"""WITH RECURSIVE e AS (SELECT 'events' AS dataset, event_id + 1 AS instance_id,
      CASE WHEN event_id + 1 > (SELECT (max(event_id) + 1) / 2 FROM events) THEN value * 3 ELSE value END::DOUBLE AS e,
      row_number() OVER (ORDER BY event_id) AS n FROM events WHERE value IS NOT NULL),
      v AS MATERIALIZED (SELECT dataset, instance_id, {SINGLE} FROM e)""",
    "dataset",
)
