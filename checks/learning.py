"""Customer tier model and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Registry, m, q, tidy
from checks.features import SQL as FEATURES
from checks.mapping import Tables, with_tables
from tarnlake.operators import trees
from tarnlake.operators.timeseries import densify
from tarnlake.plans import features, learning
from tarnlake.session import checkpointed

CUT, LEFT_OUT = "2000-01-01", "ReferenceMonth IN (DATE '1999-05-01', DATE '1999-06-01')"


def prepared(spark, sf_dir: str):
    return learning.prepare(features.customer_classification(Tables(spark, sf_dir)))


FOREST = trees.Settings()


def fitted(spark, sf_dir: str):
    """Model and test predictions. The prepared rows are stored once: training reads
    them many times."""
    train, test = trees.split_by_key(checkpointed(prepared(spark, sf_dir)), "Customer_SK")
    model = trees.fit(train, "Customer_SK", "label", learning.TIER_FEATURES, 3, FOREST)
    return model, trees.predict(test, model)


def indexed(spark, sf_dir: str):
    return tidy(prepared(spark, sf_dir).select(
        "Customer_SK", "ClientRank", "label", *[
            learning.vector_to_array("features")[i].alias(c) for i, c in enumerate(learning.TIER_FEATURES)]))


def predictions(spark, sf_dir: str):
    return tidy(fitted(spark, sf_dir)[1].select("Customer_SK", "ClientRank", "label", "prediction", "confidence"))


def splits(spark, sf_dir: str):
    """The trees themselves."""
    return tidy(fitted(spark, sf_dir)[0].splits.select("tree", "node", "feature", "bound", "gain", "weight"))


def _draw(*parts: str) -> str:
    return f"CAST('0x' || substr(md5({" || ':' || ".join(parts)}), 1, 8) AS BIGINT)"


def forest_sql(wanted: str) -> str:
    """The whole forest in SQL, level by level; ``wanted`` selects from its parts."""
    names, s, k = learning.TIER_FEATURES, FOREST, 3
    seed = f"'{s.seed}'"
    parts = [("prepared", "SELECT *, CASE ClientRank WHEN 'BRONZE' THEN 0 WHEN 'GOLD' THEN 1 ELSE 2 END AS label FROM classified"),
             ("drawn", f"SELECT *, {_draw(seed, "'split'", 'CAST(Customer_SK AS VARCHAR)')} < {int(0.8 * trees.WHOLE)} AS train FROM prepared"),
             ("long", " UNION ALL ".join(f"SELECT Customer_SK, train, {i} AS feature, CAST({f} AS DOUBLE) AS v FROM drawn" for i, f in enumerate(names))),
             ("counted", "SELECT feature, v, count(*) AS n FROM long WHERE train GROUP BY ALL"),
             ("run", "SELECT *, sum(n) OVER (PARTITION BY feature ORDER BY v) AS upto, sum(n) OVER (PARTITION BY feature) AS whole FROM counted"),
             ("cuts", f"""SELECT feature, v AS bound, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS bin FROM run
                WHERE least((upto * {s.bins}) // whole, {s.bins - 1}) > ((upto - n) * {s.bins}) // whole"""),
             ("binned", """SELECT l.Customer_SK, l.feature, count(c.bound) AS bin FROM long l
                LEFT JOIN cuts c ON c.feature = l.feature AND l.v > c.bound GROUP BY ALL"""),
             ("weighted", f"""SELECT *, {' + '.join(f'(u >= {p})::INT' for p in s.poisson)} AS weight FROM (
                SELECT Customer_SK, label, tree, {_draw(seed, "'row'", 'CAST(tree AS VARCHAR)', 'CAST(Customer_SK AS VARCHAR)')} AS u
                FROM drawn, (SELECT unnest(range({s.trees})) AS tree) AS t WHERE train) AS x"""),
             ("placed0", "SELECT Customer_SK, label, tree, weight, 1 AS node FROM weighted WHERE weight > 0")]
    lower = " + ".join(f"(md5({seed} || ':' || tree || ':' || node || ':{g}') < md5({seed} || ':' || tree || ':' || node || ':' || feature))::INT" for g in range(len(names)))

    def square(p: str) -> str:
        return f"({' + '.join(f'CAST({p}{c} AS DOUBLE) * CAST({p}{c} AS DOUBLE)' for c in range(k))}) / CAST({' + '.join(f'{p}{c}' for c in range(k))} AS DOUBLE)"

    for level in range(s.depth):
        parts += [
            (f"hist{level}", f"""SELECT p.tree, p.node, b.feature, b.bin, {', '.join(f'sum(CASE WHEN label = {c} THEN weight ELSE 0 END) AS c{c}' for c in range(k))}
                FROM placed{level} p JOIN binned b ON b.Customer_SK = p.Customer_SK WHERE p.node >= {1 << level} GROUP BY ALL"""),
            (f"cum{level}", f"""SELECT *, {', '.join(f'sum(c{c}) OVER (PARTITION BY tree, node, feature ORDER BY bin) AS l{c}, sum(c{c}) OVER (PARTITION BY tree, node, feature) AS t{c}' for c in range(k))}
                FROM hist{level} WHERE {lower} < {s.columns}"""),
            (f"gain{level}", f"""SELECT *, {square('l')} + {square('r')} - {square('t')} AS gain
                FROM (SELECT *, {', '.join(f't{c} - l{c} AS r{c}' for c in range(k))} FROM cum{level}) AS x WHERE {' + '.join(f'r{c}' for c in range(k))} > 0"""),
            (f"best{level}", f"""SELECT tree, node, feature, bin, gain, {' + '.join(f't{c}' for c in range(k))} AS weight FROM (
                SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, feature, bin) AS rn FROM gain{level}) AS x
                WHERE rn = 1 AND gain > {s.least_gain}"""),
            (f"placed{level + 1}", f"""SELECT p.Customer_SK, p.label, p.tree, p.weight,
                CASE WHEN s.node IS NULL THEN p.node ELSE p.node * 2 + (b.bin > s.bin)::INT END AS node
                FROM placed{level} p LEFT JOIN best{level} s ON s.tree = p.tree AND s.node = p.node
                  LEFT JOIN binned b ON b.Customer_SK = p.Customer_SK AND b.feature = s.feature""")]
    parts += [
        ("splits", " UNION ALL ".join(f"SELECT * FROM best{v}" for v in range(s.depth))),
        ("leaves", f"SELECT tree, node, {', '.join(f'sum(CASE WHEN label = {c} THEN weight ELSE 0 END) AS c{c}' for c in range(k))} FROM placed{s.depth} GROUP BY ALL"),
        ("test0", f"SELECT Customer_SK, tree, 1 AS node FROM drawn, (SELECT unnest(range({s.trees})) AS tree) AS t WHERE NOT train")]
    for level in range(s.depth):
        parts.append((f"test{level + 1}", f"""SELECT p.Customer_SK, p.tree, CASE WHEN s.node IS NULL THEN p.node ELSE p.node * 2 + (b.bin > s.bin)::INT END AS node
            FROM test{level} p LEFT JOIN splits s ON s.tree = p.tree AND s.node = p.node
              LEFT JOIN binned b ON b.Customer_SK = p.Customer_SK AND b.feature = s.feature"""))
    total = " + ".join(f"c{c}" for c in range(k))
    parts += [
        ("shares", f"""SELECT Customer_SK, {', '.join(f'round(sum(CAST(c{c} AS DOUBLE) / CAST({total} AS DOUBLE)) / {s.trees}, 9) AS p{c}' for c in range(k))}
            FROM test{s.depth} JOIN leaves USING (tree, node) GROUP BY ALL"""),
        ("predicted", f"""SELECT Customer_SK, ClientRank, CAST(label AS DOUBLE) AS label, greatest(p0, p1, p2) AS confidence,
            CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0.0::DOUBLE WHEN p1 >= p2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS prediction
            FROM shares JOIN drawn USING (Customer_SK)""")]
    inner = ", ".join(f"{n} AS MATERIALIZED ({q_})" for n, q_ in parts)
    return with_tables(f"SELECT * FROM (WITH {inner} {wanted}) AS forest", {**FEATURES, "classified": CLASSIFIED})


CLASSIFIED = """SELECT *, CASE
    WHEN TotalHistoricalValue >= (SELECT TotalHistoricalValue FROM ranked_customers WHERE rn = ceil(0.66::DOUBLE * n)) THEN 'GOLD'
    WHEN TotalHistoricalValue >= (SELECT TotalHistoricalValue FROM ranked_customers WHERE rn = ceil(0.33::DOUBLE * n)) THEN 'SILVER'
    ELSE 'BRONZE' END AS ClientRank FROM ranked_customers"""
SCORES = """, m AS (SELECT label, prediction, count(*)::DOUBLE AS n FROM predicted GROUP BY ALL),
    c AS (SELECT label, sum(n) AS n, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS hit FROM m GROUP BY ALL),
    p AS (SELECT prediction AS label, sum(n) AS told FROM m GROUP BY ALL),
    s AS (SELECT c.label, c.n, hit / c.n AS r, CASE WHEN coalesce(told, 0) = 0 THEN 0 ELSE hit / told END AS pr FROM c LEFT JOIN p ON c.label = p.label),
    w AS (SELECT sum(n) AS n, sum(n * r) AS r, sum(n * pr) AS pr, sum(n * CASE WHEN r + pr = 0 THEN 0 ELSE 2 * r * pr / (r + pr) END) AS f FROM s)
    SELECT metric, floor(value * 1e6 + 0.5) / 1e6 AS value FROM (SELECT 'accuracy' AS metric, (SELECT sum(hit) FROM c) / n AS value FROM w
      UNION ALL SELECT 'precision', pr / n FROM w UNION ALL SELECT 'recall', r / n FROM w UNION ALL SELECT 'f1', f / n FROM w) AS v"""


def months(spark, sf_dir: str):
    return features.demand_value_monthly(Tables(spark, sf_dir)).select("ReferenceMonth", "MonthlySalesAmount")


def time_parts(spark, sf_dir: str):
    return tidy(learning.time_split(
        months(spark, sf_dir), "ReferenceMonth", F.lit(CUT).cast("date"), F.expr(LEFT_OUT)))


def lag_error(spark, sf_dir: str):
    """Error of predicting a product month by the month before."""
    rows = features.demand_product_monthly(Tables(spark, sf_dir)).select("MonthlyQty", "Lag1Month", "YearNumber")
    return tidy(learning.smape(rows, "MonthlyQty", "Lag1Month", "YearNumber"))


def forecast(spark, sf_dir: str, method=None):
    """Monthly quantities of every territory and product category, two years ahead."""
    t = Tables(spark, sf_dir)
    monthly = (
        features.dated_lines(t).join(t["dim_product"].select("Product_SK", "Category"), "Product_SK")
        .groupBy("Territory_SK", "Category", F.trunc("ReferenceDate", "month").alias("month"))
        .agg(F.sum("OrderQty").cast("long").alias("qty"))
    )
    entity = ["Territory_SK", "Category"]
    dense = densify(monthly, entity, "month", ["qty"], step="month")
    return (method or learning.seasonal_forecast)(dense, entity, "month", "qty", "2001-01-01", "2003-12-01")


SERIES = {
    **FEATURES,
    "series": """
        SELECT Territory_SK, Category, date_trunc('month', ReferenceDate)::DATE AS month, sum(OrderQty)::BIGINT AS qty
        FROM dated_lines l JOIN dim_product p ON l.Product_SK = p.Product_SK GROUP BY ALL""",
    "dense_series": """
        SELECT r.Territory_SK, r.Category, c.ReferenceMonth AS month, coalesce(qty, 0) AS qty
        FROM (SELECT Territory_SK, Category, min(month) AS a, max(month) AS b FROM series GROUP BY ALL) AS r
          JOIN calendar_months c ON c.ReferenceMonth BETWEEN a AND b
          LEFT JOIN series s ON s.Territory_SK = r.Territory_SK AND s.Category = r.Category AND s.month = c.ReferenceMonth""",
    "season_pairs": """
        SELECT c.Territory_SK, c.Category, c.month, c.qty::DOUBLE AS y, p.qty::DOUBLE AS x
        FROM dense_series c LEFT JOIN dense_series p
          ON p.Territory_SK = c.Territory_SK AND p.Category = c.Category AND p.month = c.month - INTERVAL 12 MONTH""",
    "season_fits": """
        SELECT Territory_SK, Category, max(month) AS last, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
        FROM season_pairs GROUP BY ALL""",
}
FORECAST = """
    SELECT Territory_SK, Category, date, floor(CASE k WHEN 1 THEN a + b * base WHEN 2 THEN a + b * (a + b * base)
      WHEN 3 THEN a + b * (a + b * (a + b * base))
      ELSE list_sum(list_transform(range(k), lambda i: a * pow(b, i))) + pow(b, k) * base END * 100 + 0.5) / 100 AS prediction
    FROM (SELECT w.*, d.qty AS base FROM (
        SELECT f.*, g.date, ceil(date_diff('month', last, g.date) / 12.0)::INT AS k
        FROM season_fits f, (SELECT unnest(generate_series(DATE '2001-01-01', DATE '2003-12-01', INTERVAL 1 MONTH))::DATE AS date) AS g
        WHERE g.date > last) AS w
      JOIN dense_series d ON d.Territory_SK = w.Territory_SK AND d.Category = w.Category
        AND d.month = w.date - to_months(12 * k)) AS z"""


SMOOTHED = f"""
    SELECT * FROM (WITH RECURSIVE own AS MATERIALIZED (SELECT Territory_SK, Category, list(qty::DOUBLE ORDER BY month) AS y, max(month) AS last, count(*) AS n FROM dense_series GROUP BY ALL),
    begun AS MATERIALIZED (SELECT *, CASE WHEN n >= 24 THEN list_sum(y[1 : 12]) / 12 ELSE list_sum(y) / n END AS level,
      CASE WHEN n >= 24 THEN (list_sum(y[13 : 24]) / 12 - list_sum(y[1 : 12]) / 12) / 12 ELSE 0.0::DOUBLE END AS trend,
      CASE WHEN n >= 24 THEN list_transform(y[1 : 12], lambda x: x - list_sum(y[1 : 12]) / 12) ELSE list_transform(range(12), lambda x: 0.0::DOUBLE) END AS seasons FROM own),
    factors AS (SELECT * FROM (VALUES {', '.join(f'({k}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)' for k, (a, b, c) in enumerate(learning.GRID))}) AS v(k, a, b, c)),
    walk AS (SELECT Territory_SK, Category, k, a, b, c, y, last, n, 12::BIGINT AS t, level, trend, seasons, 0.0::DOUBLE AS error FROM begun, factors
      UNION ALL SELECT Territory_SK, Category, k, a, b, c, y, last, n, t + 1, l2, b * (l2 - level) + (1 - b) * trend,
        list_transform(range(12), lambda i: CASE WHEN i = t % 12 THEN c * (y[t + 1] - l2) + (1 - c) * was ELSE seasons[i + 1] END),
        error + abs(y[t + 1] - (level + trend) - was)
      FROM (SELECT *, a * (y[t + 1] - was) + (1 - a) * (level + trend) AS l2 FROM (SELECT *, seasons[t % 12 + 1] AS was FROM walk WHERE n >= 24 AND t < n) AS w0) AS w1),
    done AS (SELECT *, row_number() OVER (PARTITION BY Territory_SK, Category ORDER BY error, k) AS rn FROM walk WHERE n < 24 OR t = n)
    SELECT Territory_SK, Category, g.date, {q("level + date_diff('month', last, g.date) * trend + seasons[(n + date_diff('month', last, g.date) - 1) % 12 + 1]", 'prediction', 2)}
    FROM done, (SELECT unnest(generate_series(DATE '2001-01-01', DATE '2003-12-01', INTERVAL 1 MONTH))::DATE AS date) AS g
    WHERE rn = 1 AND g.date > last) AS s"""


def register(reg: Registry) -> None:
    reg.add("j01_label_and_features", indexed, with_tables("""
        SELECT Customer_SK, ClientRank, CASE ClientRank WHEN 'BRONZE' THEN 0.0::DOUBLE WHEN 'GOLD' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS label,
          """ + ", ".join(q(c, c) for c in learning.TIER_FEATURES) + """ FROM (SELECT *, CASE
          WHEN TotalHistoricalValue >= (SELECT TotalHistoricalValue FROM ranked_customers WHERE rn = ceil(0.66::DOUBLE * n)) THEN 'GOLD'
          WHEN TotalHistoricalValue >= (SELECT TotalHistoricalValue FROM ranked_customers WHERE rn = ceil(0.33::DOUBLE * n)) THEN 'SILVER'
          ELSE 'BRONZE' END AS ClientRank FROM ranked_customers) AS r""", FEATURES))
    reg.add("j02_forest_predictions", predictions, forest_sql(
        f"SELECT Customer_SK, ClientRank, label, prediction, {q('confidence', 'confidence')} FROM predicted"))
    reg.add("j02_forest_splits", splits, forest_sql(
        f"SELECT s.tree, s.node, s.feature, {q('c.bound', 'bound')}, {q('gain', 'gain')}, s.weight::BIGINT AS weight "
        "FROM splits s JOIN cuts c ON c.feature = s.feature AND c.bin = s.bin"))
    reg.add("j03_model_scores", lambda s, d: tidy(learning.scores(fitted(s, d)[1])), forest_sql(SCORES))
    reg.add("j04_confusion_matrix", lambda s, d: learning.confusion(fitted(s, d)[1]), forest_sql(
        "SELECT CAST(label AS INT) AS label, " + ", ".join(f"count_if(prediction = {c})::BIGINT AS predicted_{c}" for c in range(3)) + " FROM predicted GROUP BY ALL"))
    reg.add("j05_feature_importance", lambda s, d: tidy(trees.importances(fitted(s, d)[0])), forest_sql(
        ", g AS (SELECT tree, feature, sum(gain) AS gain FROM splits GROUP BY ALL), h AS (SELECT *, gain / sum(gain) OVER (PARTITION BY tree) AS share FROM g), "
        f"names AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{f}')" for i, f in enumerate(learning.TIER_FEATURES))}) AS v(feature, name)) "
        f"SELECT name AS feature, {q('coalesce(sum(share), 0) / (SELECT count(DISTINCT tree) FROM splits)', 'importance')} "
        "FROM names LEFT JOIN h USING (feature) GROUP BY name"))
    reg.add("j06_time_split", time_parts, with_tables(f"""
        SELECT ReferenceMonth, {m('MonthlySalesAmount')},
          CASE WHEN ReferenceMonth < DATE '{CUT}' THEN 'train' ELSE 'test' END AS part
        FROM dense_value_months WHERE NOT ({LEFT_OUT})""", FEATURES))
    reg.add("j07_smape", lag_error, with_tables(f"""
        SELECT year(ReferenceMonth)::INT AS YearNumber,
          {q('100 * avg(2 * abs(p - a) / (abs(a) + abs(p) + 1e-8::DOUBLE))', 'smape')}
        FROM (SELECT ReferenceMonth, MonthlyQty::DOUBLE AS a, coalesce(lag(MonthlyQty) OVER (
          PARTITION BY Product_SK ORDER BY ReferenceMonth), 0)::DOUBLE AS p FROM dense_product_months) AS x GROUP BY ALL""", FEATURES))
    reg.add("j08_smoothed_forecast", lambda s, d: tidy(forecast(s, d, learning.smoothed_forecast), 2), with_tables(SMOOTHED, SERIES))
    reg.add("j08_seasonal_forecast", lambda s, d: tidy(forecast(s, d), 2), with_tables(FORECAST, SERIES))
