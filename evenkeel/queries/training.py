"""Trainers with a state of their own over the whole table of vectors. Their SQL twins unroll the same training step by
step, so losses, scores and probabilities are compared by value."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import functions as F

from evenkeel.operators.boosting import fit_soft_trees
from evenkeel.operators.epochs import cross_entropy_loss, fit_epochs, focal_loss_of, log_table
from evenkeel.operators.joins import join_labels
from evenkeel.operators.sampling import stratified_folds
from evenkeel.operators.served import served
from evenkeel.operators.simplex import simplex_multipliers
from evenkeel.plans.training import tfidf_heads
from evenkeel.queries.base import SQL_LABELED, Tables, query, r6, sql_grams, sql_normalize, sql_words
from evenkeel.queries.learning import embeddings_as_features, vectors
from evenkeel.queries.rebalancing import sql_folds, sql_split
from evenkeel.session import shared_dir

CLASSES, FOLDS, EPOCHS, RATE, GAMMA = 10, 3, 3, 4.0, 2.0
WEIGHTS = {k: 1.0 + k / 8 for k in range(CLASSES)}


def _sql_epochs(focal: bool) -> str:
    """Steps ``p0 .. pT`` (margins, probabilities, losses under the weights after each epoch) and ``log``."""
    folds = sql_folds("SELECT vec_id, label FROM embeddings", "vec_id", "label", FOLDS)
    steps = [
        f"""r AS MATERIALIZED (
          SELECT f.vec_id, f.label AS y, f.fold, 1 + f.label / 8.0::DOUBLE AS w, embedding::DOUBLE[] AS e
          FROM ({folds}) f JOIN embeddings x ON f.vec_id = x.vec_id)""",
        f"""w0 AS (SELECT m, k, list_resize([]::DOUBLE[], (SELECT max(len(e)) FROM r), 0.0::DOUBLE) AS v, 0.0::DOUBLE AS b
          FROM range({FOLDS}) a(m), range({CLASSES}) c(k))""",
    ]
    if focal:
        loss, share = f"pow(1 - exp(-ce), {GAMMA}) * ce", "1.0::DOUBLE"
        change = f"pow(1 - exp(-ce), {GAMMA}) + {GAMMA} * ce * exp(-ce) * pow(1 - exp(-ce), {GAMMA - 1})"
    else:
        loss, share, change = "ce", "w", "1"
    for t in range(EPOCHS + 1):
        steps.append(f"""p{t} AS MATERIALIZED (
          WITH z AS (SELECT vec_id, y, fold, w, m, k, list_dot_product(e, v) + b AS z FROM r, w{t}),
          x AS (SELECT *, max(z) OVER o AS top FROM z WINDOW o AS (PARTITION BY vec_id, m)),
          s AS (SELECT *, exp(z - top) / sum(exp(z - top)) OVER o AS p, ln(sum(exp(z - top)) OVER o) AS rest FROM x
            WINDOW o AS (PARTITION BY vec_id, m)),
          c AS (SELECT *, w * sum(CASE WHEN k = y THEN rest - (z - top) END) OVER (PARTITION BY vec_id, m) AS ce FROM s)
          SELECT vec_id, y, fold, m, k, z, p, {loss} AS loss, {share} AS share, w * (p - (k = y)::INTEGER) * ({change}) AS g,
            row_number() OVER (PARTITION BY vec_id, m ORDER BY z DESC, k) = 1 AS said FROM c)""")
        if t:
            steps.append(f"""v{t} AS (
          WITH h AS (SELECT m, y, k, loss, share FROM p{t} WHERE said AND fold = m),
          c AS (SELECT m, c, sum(hit) AS hit, sum(n) AS n FROM (
              SELECT m, y AS c, (k = y)::INTEGER AS hit, 1 AS n FROM h UNION ALL SELECT m, k, (k = y)::INTEGER, 1 FROM h) GROUP BY m, c),
          f AS (SELECT m, avg(hit / n) AS val_f1_macro FROM c GROUP BY m)
          SELECT h.m, sum(loss) / sum(share) AS val_loss, avg((k = y)::INTEGER) AS val_acc, any_value(val_f1_macro) AS val_f1_macro
          FROM h JOIN f ON f.m = h.m GROUP BY h.m)""")
        if t == EPOCHS:
            break
        steps.append(f"""n{t} AS (SELECT m, sum(share) AS n, sum(loss) / sum(share) AS train_loss, avg((k = y)::INTEGER) AS train_acc
          FROM p{t} WHERE said AND fold != m GROUP BY m)""")
        steps.append(f"""g{t} AS MATERIALIZED (
          SELECT m, k, f, sum(g * x) AS g FROM (
            SELECT m, k, g, unnest(e) AS x, unnest(range(len(e))) AS f FROM p{t} JOIN r ON r.vec_id = p{t}.vec_id WHERE p{t}.fold != m)
          GROUP BY m, k, f)""")
        steps.append(f"""w{t + 1} AS MATERIALIZED (
          SELECT w.m, w.k, list(v[f + 1] - {RATE} * g / n ORDER BY f) AS v, any_value(w.b - {RATE} * gb / n) AS b
          FROM w{t} w JOIN g{t} g ON w.m = g.m AND w.k = g.k JOIN n{t} n ON n.m = w.m
          JOIN (SELECT m, k, sum(g) AS gb FROM p{t} WHERE fold != m GROUP BY m, k) b ON b.m = w.m AND b.k = w.k
          GROUP BY w.m, w.k)""")
    rows = " UNION ALL ".join(
        f"""SELECT n{t}.m AS model, {t + 1} AS epoch, train_loss, train_acc, val_loss, val_acc, val_f1_macro
        FROM n{t} JOIN v{t + 1} v ON v.m = n{t}.m""" for t in range(EPOCHS))
    return "WITH " + ",\n".join([*steps, f"log AS MATERIALIZED ({rows})"])


_LOG_SQL = """ SELECT model::INTEGER AS model, epoch, round(train_loss, 6) AS train_loss, round(train_acc, 6) AS train_acc,
    round(val_loss, 6) AS val_loss, round(val_acc, 6) AS val_acc, round(val_f1_macro, 6) AS val_f1_macro FROM log"""


def _trained(spark, d, loss):
    rows = stratified_folds(embeddings_as_features(Tables(spark, d)), "vec_id", "label", FOLDS)
    done = fit_epochs(
        rows, None, CLASSES, loss=loss, weights=WEIGHTS, epochs=EPOCHS, rate=RATE, schedule="constant", optimiser="sgd", decay=0.0,
        patience=EPOCHS, fold="fold", folds=FOLDS,
    )
    return rows, done


def _log(spark, done):
    names = ("train_loss", "train_acc", "val_loss", "val_acc", "val_f1_macro")
    return log_table(spark, done.log).select("model", "epoch", *[r6(c).alias(c) for c in names])


@query("epoch_training_log", _sql_epochs(False) + _LOG_SQL)
def _(spark, d):
    return _log(spark, _trained(spark, d, cross_entropy_loss)[1])


@query("focal_training_log", _sql_epochs(True) + _LOG_SQL)
def _(spark, d):
    return _log(spark, _trained(spark, d, focal_loss_of(GAMMA))[1])


def _told():
    """The class, its probability, and a sum that every other probability enters with a weight of its own."""
    return (
        "prediction", r6(F.array_max("probs")).alias("top"),
        r6(F.aggregate(F.transform("probs", lambda p, i: p * (i + 1)), F.lit(0.0), lambda a, x: a + x)).alias("mean_class"),
    )


@query(
    "epoch_training_scores",
    _sql_epochs(False) + f""",
      best AS (SELECT model, arg_min(epoch, (-val_f1_macro, epoch)) AS epoch FROM log GROUP BY model),
      own AS ({' UNION ALL '.join(f'SELECT p.*, {t} AS epoch FROM p{t} p' for t in range(1, EPOCHS + 1))})
      SELECT vec_id, y AS label, fold, max(CASE WHEN said THEN k END)::INTEGER AS prediction, round(max(p), 6) AS top,
        round(sum(p * (k + 1)), 6) AS mean_class
      FROM own JOIN best ON own.m = best.model AND own.epoch = best.epoch WHERE fold = m GROUP BY vec_id, y, fold""",
)
def _(spark, d):
    rows, done = _trained(spark, d, cross_entropy_loss)
    return done.head(rows).select("vec_id", "label", "fold", *_told())


# --- boosted trees -----------------------------------------------------------

ROUNDS, DEPTH, TREE_RATE, L2, LEAST = 2, 2, 0.3, 1.0, 1.0
BORDERS = [-0.2, -0.1, 0.0, 0.1, 0.2]


def _sql_trees() -> str:
    """Steps ``z0 .. zR`` (margins of every row under the trees of each round), and ``log``."""
    split = sql_split("SELECT vec_id, label FROM embeddings", "vec_id", "label", "0.2")
    bins = " + ".join(f"(x >= {b})::INTEGER" for b in BORDERS)
    steps = [
        f"""r AS MATERIALIZED (SELECT s.vec_id, s.label AS y, is_test, embedding::DOUBLE[] AS e
          FROM ({split}) s JOIN embeddings x ON s.vec_id = x.vec_id)""",
        f"""b AS MATERIALIZED (SELECT vec_id, f, {bins} AS bin FROM (
          SELECT vec_id, unnest(e) AS x, unnest(range(len(e))) AS f FROM r))""",
        f"z0 AS (SELECT vec_id, y, is_test, k, 0.0::DOUBLE AS z FROM r, range({CLASSES}) c(k))",
    ]
    for t in range(ROUNDS):
        steps.append(f"""s{t}_0 AS MATERIALIZED (
          WITH x AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS u FROM z{t}),
          q AS (SELECT *, u / sum(u) OVER (PARTITION BY vec_id) AS p FROM x)
          SELECT vec_id, y, is_test, k, z, p - (k = y)::INTEGER AS g, greatest(2 * p * (1 - p), 1e-16) AS h, 1 AS node, true AS open
          FROM q)""")
        for level in range(DEPTH):
            s = f"s{t}_{level}"
            steps.append(f"""c{t}_{level} AS MATERIALIZED (
              WITH a AS (SELECT k, node, f, bin, sum(g) AS g, sum(h) AS h FROM {s} JOIN b ON b.vec_id = {s}.vec_id
                WHERE open AND NOT is_test GROUP BY k, node, f, bin),
              m AS (SELECT *, sum(g) OVER o AS gl, sum(h) OVER o AS hl, sum(g) OVER (PARTITION BY k, node, f) AS ga,
                sum(h) OVER (PARTITION BY k, node, f) AS ha FROM a WINDOW o AS (PARTITION BY k, node, f ORDER BY bin)),
              n AS (SELECT *, gl * gl / (hl + {L2}) + (ga - gl) * (ga - gl) / (ha - hl + {L2}) - ga * ga / (ha + {L2}) AS gain FROM m
                WHERE bin < {len(BORDERS)} AND hl >= {LEAST} AND ha - hl >= {LEAST})
              SELECT k, node, f, bin FROM n WHERE gain > 1e-12
              QUALIFY row_number() OVER (PARTITION BY k, node ORDER BY round(gain, 9) DESC, f, bin) = 1)""")
            steps.append(f"""s{t}_{level + 1} AS MATERIALIZED (
              SELECT s.* REPLACE (CASE WHEN c.k IS NULL THEN node ELSE 2 * node + (b.bin > c.bin)::INTEGER END AS node,
                open AND c.k IS NOT NULL AS open)
              FROM {s} s LEFT JOIN (SELECT k, node AS at, f, bin FROM c{t}_{level}) c ON c.k = s.k AND c.at = s.node AND s.open
              LEFT JOIN b ON b.vec_id = s.vec_id AND b.f = c.f)""")
        s = f"s{t}_{DEPTH}"
        steps.append(f"""z{t + 1} AS MATERIALIZED (
          WITH leaf AS (SELECT k, node, -{TREE_RATE} * sum(g) / (sum(h) + {L2}) AS v FROM {s} WHERE NOT is_test GROUP BY k, node)
          SELECT vec_id, y, is_test, s.k, z + coalesce(v, 0) AS z FROM {s} s LEFT JOIN leaf ON leaf.k = s.k AND leaf.node = s.node)""")
        steps.append(f"""l{t + 1} AS MATERIALIZED (
          WITH x AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS u FROM z{t + 1}),
          q AS (SELECT *, u / sum(u) OVER (PARTITION BY vec_id) AS p FROM x)
          SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, k) = 1 AS said FROM q)""")
    return "WITH " + ",\n".join(steps)


def _trees(spark, d):
    train, held = vectors(Tables(spark, d))
    width = train.selectExpr("features").head()
    edges = [BORDERS] * (len(width[0]) if width else 0)
    model, log = fit_soft_trees(
        train, held, CLASSES, edges=edges, rounds=ROUNDS, rate=TREE_RATE, depth=DEPTH, rows=1.0, columns=1.0, l2=L2, least_weight=LEAST,
        least_gain=1e-12,
    )
    return held, model, log


@query(
    "soft_trees_log",
    _sql_trees() + " SELECT round, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss FROM (" + " UNION ALL ".join(
        f"""SELECT {t} AS round, avg(CASE WHEN NOT is_test THEN -ln(p) END) AS train_loss, avg(CASE WHEN is_test THEN -ln(p) END) AS val_loss
        FROM l{t} WHERE k = y""" for t in range(1, ROUNDS + 1)) + ")",
)
def _(spark, d):
    _held, _model, log = _trees(spark, d)
    return spark.createDataFrame(
        [(r["round"], r["train_loss"], r["val_loss"]) for r in log], "round int, train_loss double, val_loss double"
    ).select("round", r6("train_loss").alias("train_loss"), r6("val_loss").alias("val_loss"))


@query(
    "soft_trees_scores",
    _sql_trees() + f""" SELECT vec_id, y AS label, max(CASE WHEN said THEN k END)::INTEGER AS prediction, round(max(p), 6) AS top,
      round(sum(p * (k + 1)), 6) AS mean_class FROM l{ROUNDS} WHERE is_test GROUP BY vec_id, y""",
)
def _(spark, d):
    held, model, _log = _trees(spark, d)
    return model(held).select("vec_id", "label", *_told())


# --- TF-IDF heads of all folds, a vote on the test set -----------------------

TEXT_FOLDS, TEXT_EPOCHS, TEXT_CLASSES, TEXT_RATE = 3, 2, 4, 20.0


def _sql_heads() -> str:
    """Steps up to ``w1 .. wT`` (weights by fold, class and term, ``null`` for the bias) and ``log``."""
    grams = sql_grams("w")
    folds = sql_folds(f"SELECT index, label FROM ({SQL_LABELED})", "index", "label", TEXT_FOLDS)
    steps = [
        f"a AS MATERIALIZED (SELECT index, label AS y, {sql_normalize('message')} AS t FROM ({SQL_LABELED}))",
        f"fo AS MATERIALIZED (SELECT index, fold FROM ({folds}))",
        f"""tf AS MATERIALIZED (SELECT index, term, count(*) AS tf FROM
          (SELECT index, unnest({grams}) AS term FROM (SELECT index, {sql_words('t')} AS w FROM a)) GROUP BY index, term)""",
        """vocab AS MATERIALIZED (SELECT term, ln((1 + n) / (1.0::DOUBLE + df)) + 1 AS idf FROM
          (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY term) CROSS JOIN (SELECT count(*) AS n FROM a)
          WHERE df >= 2 AND df <= 0.9::DOUBLE * n QUALIFY row_number() OVER (ORDER BY cf DESC, term) <= 10000)""",
        """x AS MATERIALIZED (SELECT index, term, w / sqrt(sum(w * w) OVER (PARTITION BY index)) AS x FROM
          (SELECT index, term, tf * idf AS w FROM tf JOIN vocab USING (term)))""",
        f"""qx AS MATERIALIZED (SELECT index, term, w / sqrt(sum(w * w) OVER (PARTITION BY index)) AS x FROM
          (SELECT index, term, count(*) * any_value(idf) AS w FROM
            (SELECT item_id::VARCHAR AS index, unnest({grams}) AS term FROM
              (SELECT item_id, {sql_words('t')} AS w FROM (SELECT item_id, {sql_normalize('text')} AS t FROM benchmark)))
            JOIN vocab USING (term) GROUP BY index, term))""",
        f"r AS MATERIALIZED (SELECT a.index, y, fold, m, k FROM a JOIN fo USING (index), range({TEXT_FOLDS}) b(m), range({TEXT_CLASSES}) c(k))",
        "w0 AS (SELECT 0 AS m, 0 AS k, NULL::VARCHAR AS term, 0.0::DOUBLE AS v)",
    ]
    for t in range(TEXT_EPOCHS + 1):
        steps.append(f"""p{t} AS MATERIALIZED (
          WITH d AS (SELECT index, m, k, sum(x * v) AS z FROM x JOIN w{t} w ON w.term = x.term GROUP BY index, m, k),
          z AS (SELECT r.*, coalesce(d.z, 0) + coalesce(b.v, 0) AS z FROM r LEFT JOIN d ON d.index = r.index AND d.m = r.m AND d.k = r.k
            LEFT JOIN w{t} b ON b.term IS NULL AND b.m = r.m AND b.k = r.k),
          u AS (SELECT *, z - max(z) OVER (PARTITION BY index, m) AS u FROM z)
          SELECT *, exp(u) / sum(exp(u)) OVER o AS p, ln(sum(exp(u)) OVER o) - u AS ce,
            row_number() OVER (PARTITION BY index, m ORDER BY z DESC, k) = 1 AS said
          FROM u WINDOW o AS (PARTITION BY index, m))""")
        if t < TEXT_EPOCHS:
            steps.append(f"""n{t} AS MATERIALIZED (SELECT m, count(*) AS n, avg(ce) AS train_loss FROM p{t} WHERE k = y AND fold != m GROUP BY m)""")
            steps.append(f"""w{t + 1} AS MATERIALIZED (
              WITH g AS (SELECT index, m, k, p - (k = y)::INTEGER AS g FROM p{t} WHERE fold != m),
              s AS (SELECT m, k, term, sum(g * x) AS g FROM g JOIN x ON x.index = g.index GROUP BY m, k, term
                UNION ALL SELECT m, k, NULL, sum(g) FROM g GROUP BY m, k)
              SELECT s.m, s.k, s.term, coalesce(w.v, 0) - {TEXT_RATE} * s.g / n AS v FROM s JOIN n{t} n ON n.m = s.m
              LEFT JOIN w{t} w ON w.m = s.m AND w.k = s.k AND w.term IS NOT DISTINCT FROM s.term)""")
        if t:
            steps.append(f"""v{t} AS MATERIALIZED (
              WITH h AS (SELECT m, y, k FROM p{t} WHERE said AND fold = m),
              c AS (SELECT m, c, sum(hit) AS hit, sum(1) AS n FROM (
                SELECT m, y AS c, (k = y)::INTEGER AS hit FROM h UNION ALL SELECT m, k, (k = y)::INTEGER FROM h) GROUP BY m, c)
              SELECT m, avg(hit / n) AS f1 FROM c GROUP BY m)""")
    rows = " UNION ALL ".join(
        f"""SELECT n.m AS model, {t + 1} AS epoch, train_loss, l.val_loss, f1 AS val_f1_macro FROM n{t} n JOIN v{t + 1} v ON v.m = n.m
        JOIN (SELECT m, avg(ce) AS val_loss FROM p{t + 1} WHERE k = y AND fold = m GROUP BY m) l ON l.m = n.m""" for t in range(TEXT_EPOCHS))
    return "WITH " + ",\n".join([*steps, f"log AS MATERIALIZED ({rows})"])


def _heads(spark, d, **params):
    t = Tables(spark, d)
    test = t.benchmark.select(F.col("item_id").cast("string").alias("index"), F.col("text").alias("message"))
    return tfidf_heads(
        join_labels(t.texts(), t.classes()), test, TEXT_CLASSES, TEXT_FOLDS, epochs=TEXT_EPOCHS, rate=TEXT_RATE, schedule="constant",
        optimiser="sgd", decay=0.0, patience=TEXT_EPOCHS, **params,
    )


@query(
    "tfidf_heads",
    _sql_heads() + f""",
      best AS (SELECT model AS m, arg_min(epoch, (-val_f1_macro, epoch)) AS epoch FROM log GROUP BY model),
      own AS MATERIALIZED (SELECT w.* FROM ({' UNION ALL '.join(f'SELECT *, {t} AS epoch FROM w{t}' for t in range(1, TEXT_EPOCHS + 1))}) w
        JOIN best ON best.m = w.m AND best.epoch = w.epoch),
      d AS (SELECT index, m, k, sum(x * v) AS z FROM qx JOIN own ON own.term = qx.term GROUP BY index, m, k),
      z AS (SELECT i.index, b.m, b.k, coalesce(d.z, 0) + b.v AS z FROM (SELECT item_id::VARCHAR AS index FROM benchmark) i
        JOIN own b ON b.term IS NULL LEFT JOIN d ON d.index = i.index AND d.m = b.m AND d.k = b.k),
      e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY index, m)) AS e FROM z),
      p AS (SELECT index, k, avg(p) AS p FROM (SELECT *, e / sum(e) OVER (PARTITION BY index, m) AS p FROM e) GROUP BY index, k)
      SELECT index, arg_max(k, p)::INTEGER AS prediction, round(max(p), 6) AS top, round(sum(p * (k + 1)), 6) AS mean_class
      FROM p GROUP BY index""",
)
def _(spark, d):
    return _heads(spark, d).probs.select("index", *_told())


@query(
    "tfidf_heads_log",
    _sql_heads() + """ SELECT model::INTEGER AS model, epoch, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss,
      round(val_f1_macro, 6) AS val_f1_macro FROM log""",
)
def _(spark, d):
    log = _heads(spark, d).log
    return log.select("model", "epoch", *[r6(c).alias(c) for c in ("train_loss", "val_loss", "val_f1_macro")])


# multipliers that a simplex finds for the out-of-fold probabilities; the walk itself is held against a plain one in tests
@query("simplex_multipliers")
def _(spark, d):
    _rows, done = _trained(spark, d, cross_entropy_loss)
    best, f1, base = simplex_multipliers(done.head(_rows), CLASSES)
    return spark.createDataFrame(
        [(k, round(m, 6), round(f1, 6), round(base, 6)) for k, m in enumerate(best)],
        "class int, multiplier double, f1_macro double, argmax_f1_macro double",
    )


# --- a caller's own model ----------------------------------------------------


def nearest_mean(content: bytes):
    """A model file with one mean vector a line: closer classes are more probable."""
    rows = sorted((json.loads(line) for line in content.decode().splitlines() if line), key=lambda r: r["label"])
    means = np.array([r["mean"] for r in rows])

    def model(columns):
        x = np.array(columns["x"].to_pylist())
        e = np.exp(-np.square(x[:, None] - means).sum(axis=2))
        return e / e.sum(axis=1, keepdims=True)

    return model


@query(
    "callers_model",
    f"""WITH s AS ({sql_split('SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings', 'vec_id', 'label', '0.2')}),
        l AS (SELECT label, f, avg(x) AS x FROM (
          SELECT label, unnest(e) AS x, unnest(range(len(e))) AS f FROM s WHERE NOT is_test) GROUP BY label, f),
        m AS (SELECT label, list(x ORDER BY f) AS mean FROM l GROUP BY label),
        z AS (SELECT vec_id, s.label, m.label AS k, exp(-list_sum(list_transform(list_zip(e, mean), lambda p: pow(p[1] - p[2], 2)))) AS z
          FROM s, m WHERE is_test),
        p AS (SELECT vec_id, label, k, z / sum(z) OVER (PARTITION BY vec_id) AS p FROM z)
        SELECT vec_id, label, arg_max(k, p)::INTEGER AS prediction, round(max(p), 6) AS top, round(sum(p * (k + 1)), 6) AS mean_class
        FROM p GROUP BY vec_id, label""",
)
def _(spark, d):
    train, held = vectors(Tables(spark, d))
    cells = train.select("label", F.posexplode(F.unwrap_udt("features")["values"]).alias("f", "x")).groupBy("label", "f").agg(F.avg("x").alias("x"))
    means = cells.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("f", "x"))), lambda c: c["x"]).alias("mean"))
    path = shared_dir(spark, "means")
    means.write.json(path)
    rows = held.select("vec_id", "label", F.unwrap_udt("features")["values"].alias("x"))
    return served(rows, nearest_mean, path, ["x"]).select("vec_id", "label", *_told())
