"""Queries of features, embeddings and models."""

from pyspark.sql import functions as F

from convlens import constants as K
from convlens import session
from convlens.catalog.base import PROMPTS, query, r6
from convlens.functions import text as TX
from convlens.operators import embeddings, linear, models, quality, sampling, tfidf


@query("tfidf", f"""
WITH {PROMPTS}, w AS (SELECT doc_id, regexp_extract_all(lower(text), '{K.TERM_TOKEN}') AS w FROM prompts),
g AS (SELECT doc_id, unnest(w) AS term FROM w
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY doc_id, term),
n AS (SELECT count(*) AS n FROM prompts),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
kept AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM df, n WHERE df >= 5 AND df <= 0.9 * n),
wt AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN kept USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM wt""")
def tfidf_weights(t):
    rows = t.prompt_texts().select("doc_id", "text")
    weights = tfidf.tfidf(rows, "doc_id", TX.term_tokens(F.col("text")), 2, 5, 0.9)
    return weights.withColumn("weight", r6("weight"))


@query("class_weights", f"""
WITH {PROMPTS}, n AS (SELECT toxic AS harm, count(*) AS n FROM prompts GROUP BY toxic)
SELECT harm, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM n""")
def class_weights(t):
    weights = tfidf.class_weights(t.prompts().select(F.col("toxic").alias("harm")), "harm")
    return weights.withColumn("weight", r6("weight"))


@query("embedding_checks", """
SELECT count(*) FILTER (embedding IS NULL) AS missing, count(*) FILTER (len(embedding) <> 64) AS wrong_size,
       count(*) FILTER (len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) > 0) AS not_finite,
       (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS without_embedding,
       (SELECT count(*) FROM embeddings JOIN labels ON vec_id = doc_id WHERE quality = 1) AS train_vectors
FROM embeddings""")
def embedding_checks(t):
    vectors = t("embeddings")
    missing = quality.unmatched(t("documents").select("doc_id"), vectors, "doc_id", "vec_id").agg(F.count("*")).scalar()
    train = (
        vectors.select(F.col("vec_id").alias("doc_id")).join(t("labels").filter("quality = 1"), "doc_id").agg(F.count("*")).scalar()
    )
    found = quality.violations(vectors, quality.embedding_rules("embedding", 64))
    return found.select("*", missing.alias("without_embedding"), train.alias("train_vectors"))


@query("nearest_label", """
WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS v FROM embeddings),
m AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS v FROM x GROUP BY label, i),
c AS (SELECT label, list(v ORDER BY i) AS centre FROM m GROUP BY label),
s AS (SELECT vec_id, c.label AS label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre) AS cos FROM embeddings, c),
p AS (SELECT vec_id, label, exp(cos) / sum(exp(cos)) OVER (PARTITION BY vec_id) AS share,
             row_number() OVER (PARTITION BY vec_id ORDER BY cos DESC, label) AS k FROM s)
SELECT vec_id, label AS nearest, round(share, 6) AS nearest_score FROM p WHERE k = 1""")
def nearest_label(t):
    vectors = t("embeddings")
    labels = embeddings.label_vectors(vectors, "label", "embedding")
    near = embeddings.nearest_label(vectors.select("vec_id", "embedding"), "embedding", labels, "label")
    return near.select("vec_id", "nearest", r6("nearest_score").alias("nearest_score"))


@query("embed_texts")
def embed_texts(t):
    rows = t.texts("documents").select("doc_id", "text")
    model = embeddings.fit_word_vectors(rows, "text", size=16)
    return embeddings.embed_by_words(rows, "doc_id", "text", model)


def split_texts(t):
    rows = t.prompt_texts().select("doc_id", F.col("toxic").alias("harm"), TX.clean_text(F.col("text")).alias("text"))
    split = session.stage(sampling.stratified_split(rows.select("doc_id", "harm"), "harm", "doc_id", 0.2))
    return rows.join(split.select("doc_id", "split"), "doc_id")


@query("logreg_scores")
def logreg_scores(t):
    fitted = models.fit_texts(split_texts(t), F.col("split") == "train", "text", "harm", [(5, 8.0)])
    return fitted.scored().filter("split = 'val'").select("doc_id", "harm", "prob", "pred")


@query("logreg_grid")
def logreg_grid(t):
    return models.text_grid(split_texts(t), F.col("split") == "train", "text", "harm")


@query("top_weights")
def top_weights(t):
    train = split_texts(t).filter("split = 'train'")
    fitted = models.fit_texts(train, F.lit(True), "text", "harm", [(5, 1.0)], stop=K.ENGLISH_STOP, max_df=0.9)
    return models.top_weights(session.stage(fitted.weights()), 20)


def vector_splits(t):
    rows = t("embeddings").select(
        "vec_id", (F.col("label") >= 5).cast("int").alias("harm"), "embedding"
    )
    split = session.stage(sampling.stratified_split(rows.select("vec_id", "harm"), "harm", "vec_id", 0.2))
    both = models.with_vectors(rows.join(split.select("vec_id", "split"), "vec_id"), "embedding").drop("embedding")
    return both.filter("split = 'train'").drop("split"), both.filter("split = 'val'").drop("split")


@query("mlp_scores")
def mlp_scores(t):
    train, val = vector_splits(t)
    rows = models.held(train)
    model = models.feed_forward("harm", 64).fit(models.for_passes(rows, 64))
    rows.unpersist()
    return models.score(model, val).select("vec_id", "harm", "prob", "pred")


@query("mlp_sweep")
def mlp_sweep(t):
    train, val = vector_splits(t)
    hidden = [(128, 64), (64, 32), (32, 16), (128,), (64,), (32,), (128, 64, 32)]
    configs = [{"hidden": h} for h in hidden] + [{"hidden": (64, 32), "step": s} for s in (0.01, 0.03, 0.1, 0.3)]
    return models.ranked_runs(models.sweep(train, val, "harm", 64, dict(enumerate(configs))))


@query("seeds_and_arms")
def seeds_and_arms(t, small=100):
    """A balanced sample of `small` rows against all rows, each with three seeds."""
    train, test = vector_splits(t)
    arms = {"A": sampling.sample_balanced(train, small, "harm", "vec_id", complete=False), "B": train}
    return models.seeds_and_arms(arms, test, "harm", 64, (42, 1234, 7))


# A linear model with given weights: a term's weight is a number from its digest.
GIVEN = f"""{PROMPTS}, w AS (SELECT doc_id, regexp_extract_all(lower(text), '{K.TERM_TOKEN}') AS w FROM prompts),
g AS (SELECT doc_id, unnest(w) AS term FROM w
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY doc_id, term),
n AS (SELECT count(*) AS n FROM prompts),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
terms AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf, CAST('0x' || substr(md5(term), 1, 4) AS BIGINT) / 65535.0 - 0.5 AS w
          FROM df, n WHERE df >= 5),
raw AS (SELECT doc_id, term, w, (1 + ln(tf)) * idf AS x FROM tf JOIN terms USING (term)),
x AS (SELECT doc_id, term, w, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS x FROM raw),
m AS (SELECT doc_id, sum(x * w) AS m FROM x GROUP BY doc_id),
rows AS (SELECT doc_id, toxic AS harm, 1.0 / (2 * count(*) OVER (PARTITION BY toxic)) AS share, coalesce(m, 0) - 0.25 AS m
         FROM prompts LEFT JOIN m USING (doc_id)),
r AS (SELECT *, 1 / (1 + exp(-m)) AS prob FROM rows)"""
INTERCEPT, PENALTY = -0.25, 0.001


def given_model(t):
    """Labels, features and vocabulary of all prompts as staged tables, with the given weights."""
    rows = t.prompt_texts().select("doc_id", "text", F.col("toxic").alias("harm"))
    counts = session.stage(tfidf.term_counts(rows, "doc_id", TX.term_tokens(F.col("text")), 2))
    weight = F.conv(F.substring(F.md5("term"), 1, 4), 16, 10).cast("bigint") / 65535.0 - 0.5
    words = session.stage(linear.vocabulary(counts, rows.agg(F.count("*")).scalar(), 5).withColumn("w", weight))
    return rows, linear.shares(rows, "doc_id", "harm"), session.stage(linear.features(counts, words, "doc_id")), words


@query("linear_scores", f"WITH {GIVEN} SELECT doc_id, harm, round(prob, 6) AS prob, CAST(prob >= 0.5 AS INTEGER) AS pred FROM r")
def linear_scores(t):
    rows, _, x, words = given_model(t)
    scored = linear.scores(rows.select("doc_id", "harm"), x, words, INTERCEPT, "doc_id")
    return scored.select("doc_id", "harm", r6("prob").alias("prob"), "pred")


@query("linear_loss", f"""
WITH {GIVEN}, s AS (SELECT sum(w * w) AS ww FROM terms)
SELECT round(sum(share * (ln(1 + exp(-abs(m))) + greatest(m, 0.0) - m * harm)) + {PENALTY / 2} * any_value(ww), 6) AS loss,
       round(sum(share * (prob - harm)), 6) AS intercept_gradient FROM r, s""")
def linear_loss(t):
    _, labels, x, words = given_model(t)
    found = linear.loss(labels, x, words, INTERCEPT, PENALTY)
    return found.select(r6("loss").alias("loss"), r6("intercept_gradient").alias("intercept_gradient"))


@query("linear_gradient", f"""
WITH {GIVEN}
SELECT term, round(sum(x * share * (prob - harm)) + {PENALTY} * any_value(w), 9) AS gradient FROM x JOIN r USING (doc_id) GROUP BY term""")
def linear_gradient(t):
    _, labels, x, words = given_model(t)
    found = linear.gradient(labels, x, words, INTERCEPT, PENALTY)
    return words.select("term_id", "term").join(found, "term_id").select("term", F.round("g", 9).alias("gradient"))


@query("linear_top_terms", f"""
WITH {GIVEN}, u AS (SELECT term, w, row_number() OVER (ORDER BY w DESC, term) AS up, row_number() OVER (ORDER BY w, term) AS down FROM terms)
SELECT 'harmful' AS side, term, round(w, 6) AS weight FROM u WHERE up <= 20
UNION ALL SELECT 'unharmful', term, round(w, 6) FROM u WHERE down <= 20""")
def linear_top_terms(t):
    _, _, _, words = given_model(t)
    return linear.top_terms(words, 20).select("side", "term", r6("w").alias("weight"))


def given_layers(sizes=(64, 8, 4, 2)):
    """Weights and biases of a small network, each a sine of its place."""
    import math

    return [
        ([[math.sin(1 + k + 2 * i + 3 * j) for j in range(a)] for i in range(b)], [math.sin(5 + k + i) for i in range(b)])
        for k, (a, b) in enumerate(zip(sizes, sizes[1:]))
    ]


def sql_layers() -> str:
    """Layer after layer: sigmoid inside, shares at the end."""
    steps, last = ["l0 AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"], len(given_layers())
    for k, (weights, biases) in enumerate(given_layers(), 1):
        nodes = [f"list_dot_product(v, {[float(x) for x in row]}::DOUBLE[]) + ({b!r})" for row, b in zip(weights, biases)]
        if k < last:
            nodes = [f"1 / (1 + exp(-({n})))" for n in nodes]
        steps.append(f"l{k} AS (SELECT vec_id, label, [{', '.join(nodes)}] AS v FROM l{k - 1})")
    return ", ".join(steps)


@query("network_scores", f"""
WITH {sql_layers()}
SELECT vec_id, CAST(label >= 5 AS INTEGER) AS harm, round(exp(v[2]) / (exp(v[1]) + exp(v[2])), 6) AS prob,
       CAST(exp(v[2]) / (exp(v[1]) + exp(v[2])) >= 0.5 AS INTEGER) AS pred FROM l3""")
def network_scores(t):
    rows = t("embeddings").select("vec_id", (F.col("label") >= 5).cast("int").alias("harm"), "embedding")
    scored = models.forward(rows, "embedding", given_layers())
    return scored.select("vec_id", "harm", r6("prob").alias("prob"), "pred")


@query("embed_hashed", """
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w FROM documents),
d AS (SELECT doc_id, md5(w) AS h FROM w),
v AS (SELECT doc_id, i, avg(CAST('0x' || substr(h, 4 * i + 1, 4) AS BIGINT) / 65535.0 - 0.5) AS x FROM d, (SELECT range AS i FROM range(8)) GROUP BY doc_id, i)
SELECT doc_id, i AS dimension, round(CAST(CAST(coalesce(x, 0.0) AS FLOAT) AS DOUBLE), 4) + 0.0 AS x
FROM documents CROSS JOIN (SELECT range AS i FROM range(8)) LEFT JOIN v USING (doc_id, i)""")
def embed_hashed(t):
    found = embeddings.embed_tokens(t.texts("documents"), "doc_id", "text", lambda: embeddings.HashedTokens(8), "hashed")
    each = found.select("doc_id", F.posexplode("embedding").alias("dimension", "x"))
    return each.select("doc_id", F.col("dimension").cast("bigint").alias("dimension"), (F.round(F.col("x").cast("double"), 4) + 0.0).alias("x"))
