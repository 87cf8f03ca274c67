"""Features, statistics and models over the given tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml import classification as mc
from pyspark.ml import clustering as mk
from pyspark.ml import evaluation as me
from pyspark.ml import feature as mf
from pyspark.ml import regression as mr
from pyspark.ml import stat as ms
from pyspark.ml import tuning as mt
from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import learning as ln
from ..session import materialise
from ..streaming import runner
from .graphs import user_links
from .registry import Tables, query
from .requests import rounded


@query(
    "feat_tokenise",
    r"""
    WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS words FROM documents)
    SELECT doc_id, len(words)::INTEGER AS n_tokens, len(list_filter(words, lambda x: x NOT IN ('the', 'of', 'and')))::INTEGER AS n_kept,
      greatest(len(words) - 1, 0)::INTEGER AS n_bigrams FROM w
    """,
)
def feat_tokenise(t: Tables) -> DataFrame:
    df = ln.tokens(t("documents").select("doc_id", "text"), "text")
    df = mf.StopWordsRemover(inputCol="tokens", outputCol="kept", stopWords=["the", "of", "and"], locale="en_US").transform(df)
    df = mf.NGram(n=2, inputCol="tokens", outputCol="bigrams").transform(df)
    return df.select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.size("kept").alias("n_kept"), F.size("bigrams").alias("n_bigrams")
    )


@query(
    "feat_tfidf",
    r"""
    WITH w AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> ''))) AS word FROM documents)
    SELECT word, count(*)::BIGINT AS df, round(ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)), 8) AS idf FROM w GROUP BY 1
    """,
)
def feat_tfidf(t: Tables) -> DataFrame:
    return rounded(ln.word_idf(t("documents"), "doc_id", "text"), 8)


@query("feat_hashed")
def feat_hashed(t: Tables) -> DataFrame:
    """Hashed TF-IDF vectors, and hashed columns of mixed types."""
    docs = ln.tfidf(t("documents").select("doc_id", "lang", "source", "n_chars", "text"), "text")
    hasher = mf.FeatureHasher(inputCols=["lang", "source", "n_chars"], outputCol="mixed", numFeatures=64)
    out = hasher.transform(docs)
    norm = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, x: s + x * x)
    return out.select("doc_id", F.round(norm, 6).alias("weight"), F.size(vector_to_array("mixed")).alias("slots"))


@query("feat_word2vec")
def feat_word2vec(t: Tables) -> DataFrame:
    df = ln.tokens(t("documents").select("text"), "text")
    return ln.word_vectors(df, "tokens", size=16, seed=3).select("word", F.size("vector").alias("size"))


@query(
    "feat_scale",
    """
    WITH s AS (SELECT avg(p_size) AS ms, stddev_samp(p_size) AS ss, min(p_size) AS lo, max(p_size) AS hi, max(abs(p_retailprice)) AS top FROM part)
    SELECT p_partkey, round((p_size - ms) / ss, 8) AS standard, round((p_size - lo) / (hi - lo), 8) AS minmax, round(p_retailprice / top, 8) AS maxabs,
      round(p_size / sqrt(p_size * p_size + p_retailprice * p_retailprice), 8) AS norm, round(p_retailprice * 0.5, 8) AS product FROM part, s
    """,
)
def feat_scale(t: Tables) -> DataFrame:
    df = ln.assembled(t("part"), ["p_size", "p_retailprice"], "v")
    stages = [
        mf.StandardScaler(inputCol="v", outputCol="a", withMean=True, withStd=True),
        mf.MinMaxScaler(inputCol="v", outputCol="b"),
        mf.MaxAbsScaler(inputCol="v", outputCol="c"),
        mf.Normalizer(inputCol="v", outputCol="d", p=2.0),
        mf.ElementwiseProduct(inputCol="v", outputCol="e", scalingVec=Vectors.dense([2.0, 0.5])),
    ]
    out = Pipeline(stages=stages).fit(df).transform(df)
    picks = [("a", 0, "standard"), ("b", 0, "minmax"), ("c", 1, "maxabs"), ("d", 0, "norm"), ("e", 1, "product")]
    return rounded(out.select("p_partkey", *[vector_to_array(c)[i].alias(n) for c, i, n in picks]), 8)


@query(
    "feat_bucket",
    """
    WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS b FROM customer)
    SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 AND b > 1000 THEN 1.0 WHEN c_custkey % 9 = 0 AND (SELECT avg(b) FROM c) > 1000 THEN 1.0 ELSE 0.0 END::DOUBLE AS above,
      CASE WHEN f < 0 THEN 0.0 WHEN f < 5000 THEN 1.0 ELSE 2.0 END::DOUBLE AS bucket, round(f, 6) AS filled
    FROM (SELECT *, coalesce(b, (SELECT avg(b) FROM c)) AS f FROM c)
    """,
)
def feat_bucket(t: Tables) -> DataFrame:
    src = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("b"))
    stages = [
        mf.Imputer(inputCols=["b"], outputCols=["filled"]),
        mf.Binarizer(threshold=1000.0, inputCol="filled", outputCol="above"),
        mf.Bucketizer(splits=[-float("inf"), 0, 5000, float("inf")], inputCol="filled", outputCol="bucket"),
    ]
    out = Pipeline(stages=stages).fit(src).transform(src)
    return out.select("c_custkey", "above", "bucket", F.round("filled", 6).alias("filled"))


@query("feat_quantile")
def feat_quantile(t: Tables) -> DataFrame:
    src = t("customer").select("c_custkey", "c_acctbal")
    return mf.QuantileDiscretizer(numBuckets=4, inputCol="c_acctbal", outputCol="quarter").fit(src).transform(src)


@query(
    "feat_index",
    """
    WITH f AS (SELECT c_mktsegment AS s, (row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1)::DOUBLE AS i FROM customer GROUP BY 1)
    SELECT c_custkey, i AS idx, c_mktsegment AS back, (CASE WHEN i < (SELECT max(i) FROM f) THEN 1 ELSE 0 END)::DOUBLE AS hot
    FROM customer JOIN f ON s = c_mktsegment
    """,
)
def feat_index(t: Tables) -> DataFrame:
    src = t("customer").select("c_custkey", "c_mktsegment")
    model = mf.StringIndexer(inputCol="c_mktsegment", outputCol="idx").fit(src)
    out = model.transform(src)
    out = mf.IndexToString(inputCol="idx", outputCol="back", labels=model.labels).transform(out)
    out = mf.OneHotEncoder(inputCols=["idx"], outputCols=["vec"]).fit(out).transform(out)
    hot = F.aggregate(vector_to_array("vec"), F.lit(0.0), lambda s, x: s + x)
    return out.select("c_custkey", "idx", "back", hot.alias("hot"))


@query(
    "feat_vector",
    """
    SELECT p_partkey, p_retailprice AS sliced, (p_size * p_size)::DOUBLE AS square, p_size * p_retailprice AS crossed, p_size * 2.0::DOUBLE AS doubled FROM part
    """,
)
def feat_vector(t: Tables) -> DataFrame:
    src = t("part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    df = ln.assembled(src, ["p_size", "p_retailprice"], "v")
    df = mf.VectorSizeHint(inputCol="v", size=2).transform(df)
    df = mf.VectorSlicer(inputCol="v", outputCol="s", indices=[1]).transform(df)
    df = mf.PolynomialExpansion(degree=2, inputCol="v", outputCol="p").transform(df)
    df = mf.Interaction(inputCols=["p_size", "p_retailprice"], outputCol="x").transform(df)
    df = mf.SQLTransformer(statement="SELECT *, p_size * 2 AS doubled FROM __THIS__").transform(df)
    # degree-2 terms come as x, x^2, y, xy, y^2
    return df.select(
        "p_partkey", vector_to_array("s")[0].alias("sliced"), vector_to_array("p")[1].alias("square"),
        vector_to_array("x")[0].alias("crossed"), "doubled",
    )


@query("feat_project")
def feat_project(t: Tables) -> DataFrame:
    """Principal components, cosine transform, formula and chi-square selection."""
    src = ln.embedded(t("embeddings"))
    df = mf.PCA(k=3, inputCol="features", outputCol="pca").fit(src).transform(src)
    df = mf.DCT(inputCol="features", outputCol="dct").transform(df)
    df = mf.Binarizer(threshold=0.0, inputCol="features", outputCol="signs").transform(df)
    picked = mf.UnivariateFeatureSelector(featuresCol="signs", labelCol="label", outputCol="picked").setFeatureType(
        "categorical"
    ).setLabelType("categorical").setSelectionThreshold(4)
    df = picked.fit(df).transform(df)
    return df.select(
        "vec_id", F.size(vector_to_array("pca")).alias("components"), F.size(vector_to_array("dct")).alias("waves"),
        F.size(vector_to_array("picked")).alias("selected"),
    )


@query(
    "feat_formula",
    """
    SELECT c_custkey, (SELECT count(DISTINCT c_mktsegment) FROM customer)::INTEGER AS size, c_nationkey::DOUBLE AS nation, c_acctbal AS label FROM customer
    """,
)
def feat_formula(t: Tables) -> DataFrame:
    """One number column and the segments but one as columns of 0 and 1."""
    src = t("customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    out = mf.RFormula(formula="c_acctbal ~ c_nationkey + c_mktsegment").fit(src).transform(src)
    features = vector_to_array("features")
    return out.select("c_custkey", F.size(features).alias("size"), features[0].alias("nation"), "label")


@query(
    "feat_vector_index",
    "SELECT p_partkey, (dense_rank() OVER (ORDER BY p_size) - 1)::DOUBLE AS size_index, p_retailprice::DOUBLE AS price FROM part",
)
def feat_vector_index(t: Tables) -> DataFrame:
    df = ln.assembled(t("part"), ["p_size", "p_retailprice"], "v")
    out = mf.VectorIndexer(inputCol="v", outputCol="i", maxCategories=60).fit(df).transform(df)
    return out.select("p_partkey", vector_to_array("i")[0].alias("size_index"), vector_to_array("i")[1].alias("price"))


@query(
    "lsh_near_passages",
    r"""
    WITH w AS (SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(text), '[^ \t\n\r\f\v]+') AS w FROM documents
      UNION ALL SELECT 'b', item_id, regexp_extract_all(lower(text), '[^ \t\n\r\f\v]+') FROM benchmark),
    g AS (SELECT side, id, unnest(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS x FROM w WHERE len(w) > 0),
    n AS (SELECT id, count(*) AS n FROM g WHERE side = 'b' GROUP BY id)
    SELECT d.id AS doc_id, b.id AS item_id, round(count(*) / any_value(n), 6) AS share
    FROM g d JOIN g b ON d.x = b.x JOIN n ON n.id = b.id WHERE d.side = 'd' AND b.side = 'b' GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(n)
    """,
)
def lsh_near_passages(t: Tables) -> DataFrame:
    out = ln.near_passages(t("documents"), t("benchmark"), "doc_id", "item_id", "text", 0.8)
    return out.withColumn("share", F.round("share", 6))


@query(
    "lsh_nearest",
    """
    WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, round(sqrt(list_sum(list_transform(list_zip(embedding, e), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))), 6) AS distance
    FROM embeddings, q ORDER BY distance, vec_id LIMIT 10
    """,
)
def lsh_nearest(t: Tables) -> DataFrame:
    return ln.nearest(t("embeddings"), "vec_id", 0, 10).withColumn("distance", F.round("distance", 6))


def _labelled(t: Tables) -> DataFrame:
    docs = t("documents").join(t("labels"), "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    return ln.tfidf(docs, "text", 1 << 10)


def _halves(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key, the same on every run."""
    test = F.pmod(F.xxhash64(key), F.lit(4)) == 0
    return df.filter(~test).cache(), df.filter(test).cache()


@query("classify_text")
def classify_text(t: Tables) -> DataFrame:
    train, test = _halves(_labelled(t), "doc_id")
    models = {
        "logistic": mc.LogisticRegression(maxIter=10, regParam=0.1, elasticNetParam=0.2),
        "linear svc": mc.LinearSVC(maxIter=5, regParam=0.1),
        "naive bayes": mc.NaiveBayes(),
    }
    return ln.accuracy_table(models, train, test)


def _vectors(t: Tables) -> DataFrame:
    return ln.embedded(t("embeddings")).select("vec_id", "features", F.col("label").cast("double").alias("label"))


@query("classify_trees")
def classify_trees(t: Tables) -> DataFrame:
    src = _vectors(t).withColumn("label", (F.col("label") % 2))
    train, test = _halves(src, "vec_id")
    models = {
        "tree": mc.DecisionTreeClassifier(maxDepth=4),
        "forest": mc.RandomForestClassifier(numTrees=8, maxDepth=4, seed=5),
        "boosted": mc.GBTClassifier(maxIter=3, maxDepth=3, seed=5),
    }
    return ln.accuracy_table(models, train, test)


@query("classify_many")
def classify_many(t: Tables) -> DataFrame:
    train, test = _halves(_vectors(t), "vec_id")
    shape = t("embeddings").agg(F.max(F.size("embedding")).alias("d"), (F.max("label") + 1).alias("c")).first()
    models = {
        "multinomial": mc.LogisticRegression(maxIter=8, family="multinomial"),
        "perceptron": mc.MultilayerPerceptronClassifier(layers=[shape["d"], 8, shape["c"]], maxIter=15, seed=5),
        "one against rest": mc.OneVsRest(classifier=mc.LogisticRegression(maxIter=4)),
    }
    return ln.accuracy_table(models, train, test)


@query(
    "regress_linear",
    """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
      round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem
    """,
)
def regress_linear(t: Tables) -> DataFrame:
    df = ln.assembled(t("lineitem").select("l_quantity", F.col("l_extendedprice").alias("label")), ["l_quantity"])
    model = mr.LinearRegression(solver="normal").fit(df)
    row = [(round(float(model.coefficients[0]), 4), round(model.intercept, 3), round(model.summary.r2, 6))]
    return t.spark.createDataFrame(row, "slope double, intercept double, r2 double")


@query("regress_models")
def regress_models(t: Tables) -> DataFrame:
    src = t("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("key"), "l_quantity", "l_discount", "l_tax",
        F.col("l_extendedprice").alias("label"), F.lit(1.0).alias("censor"),
    )
    train, test = _halves(ln.assembled(src, ["l_quantity", "l_discount", "l_tax"]), "key")
    models = {
        "elastic net": mr.LinearRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8),
        "generalised": mr.GeneralizedLinearRegression(family="gaussian", link="identity", maxIter=5),
        "isotonic": mr.IsotonicRegression(featureIndex=0),
        "survival": mr.AFTSurvivalRegression(censorCol="censor", maxIter=10),
        "tree": mr.DecisionTreeRegressor(maxDepth=4),
        "forest": mr.RandomForestRegressor(numTrees=5, maxDepth=4, seed=5),
        "boosted": mr.GBTRegressor(maxIter=3, maxDepth=3, seed=5),
    }
    return ln.error_table(models, train, test)


@query("cluster")
def cluster(t: Tables) -> DataFrame:
    """Cluster sizes of k-means, bisecting k-means and a Gaussian mixture."""
    src = _vectors(t).cache()
    small = mf.PCA(k=4, inputCol="features", outputCol="low").fit(src).transform(src).cache()
    models = {
        "k-means": mk.KMeans(k=5, seed=1, maxIter=10),
        "bisecting": mk.BisectingKMeans(k=5, seed=1, maxIter=5),
        "mixture": mk.GaussianMixture(k=3, seed=1, maxIter=5, featuresCol="low"),
    }
    out = None
    for name, estimator in models.items():
        part = estimator.fit(small).transform(small).groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
        part = part.select(F.lit(name).alias("model"), "cluster", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("cluster_topics")
def cluster_topics(t: Tables) -> DataFrame:
    df = ln.tokens(t("documents").select("doc_id", "text"), "text")
    counted = mf.CountVectorizer(inputCol="tokens", outputCol="features", minDF=2).fit(df).transform(df)
    model = mk.LDA(k=4, maxIter=3, seed=1, optimizer="online").fit(counted)
    topic = vector_to_array("topicDistribution")
    return model.transform(counted).select("doc_id", F.array_position(topic, F.array_max(topic)).alias("topic"))


@query("cluster_power")
def cluster_power(t: Tables) -> DataFrame:
    edges = user_links(t).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).groupBy("src", "dst").agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )
    return mk.PowerIterationClustering(k=3, maxIter=5, weightCol="weight").assignClusters(edges)


@query("recommend")
def recommend(t: Tables) -> DataFrame:
    """Top three parts per customer out of what they ordered."""
    ratings = (
        t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item"))
        .agg(F.sum("l_quantity").cast("float").alias("rating"))
    )
    model = ALS(rank=4, maxIter=2, userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop", seed=2).fit(ratings)
    best = ln.top_products(model.userFactors, model.itemFactors, 3)
    return best.select(F.col("left").alias("user"), F.col("right").alias("item"), F.col("product").alias("rating"))


@query("recommend_error")
def recommend_error(t: Tables) -> DataFrame:
    ratings = t("events").groupBy(F.col("user_id").cast("int").alias("user"), (F.col("event_id") % 40).cast("int").alias("item")).agg(
        F.count(F.lit(1)).cast("float").alias("rating")
    )
    train, test = _halves(ratings.withColumn("k", F.concat_ws("-", "user", "item")), "k")
    rows = []
    for implicit in (False, True):
        model = ALS(rank=4, maxIter=3, userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop", implicitPrefs=implicit, seed=2)
        predicted = model.fit(train).transform(test)
        rows.append((implicit, me.RegressionEvaluator(labelCol="rating", predictionCol="prediction").evaluate(predicted)))
    return t.spark.createDataFrame(rows, "implicit boolean, rmse double")


@query(
    "patterns",
    """
    WITH RECURSIVE b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS x FROM lineitem JOIN part ON l_partkey = p_partkey),
    s AS (SELECT o, x AS last, x AS items FROM b UNION ALL SELECT s.o, b.x, s.items || ',' || b.x FROM s JOIN b ON s.o = b.o AND b.x > s.last)
    SELECT items, count(*)::BIGINT AS freq FROM s GROUP BY items HAVING count(*) >= (SELECT ceil(0.005 * count(DISTINCT o)) FROM b)
    """,
)
def patterns(t: Tables) -> DataFrame:
    """Brands bought together; a basket holds at most as many items as there are brands."""
    found = FPGrowth(itemsCol="items", minSupport=0.005, minConfidence=0.01).fit(_baskets(t)).freqItemsets
    return found.select(F.array_join(F.array_sort("items"), ",").alias("items"), "freq")


def _baskets(t: Tables) -> DataFrame:
    """Baskets written once: the fit reads them several times."""
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return materialise(lines.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("items")), "baskets")


@query(
    "patterns_rules",
    """
    WITH RECURSIVE b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS x FROM lineitem JOIN part ON l_partkey = p_partkey),
    s AS (SELECT o, x AS last, [x] AS items FROM b UNION ALL SELECT s.o, b.x, list_append(s.items, b.x) FROM s JOIN b ON s.o = b.o AND b.x > s.last),
    n AS (SELECT count(DISTINCT o) AS n FROM b),
    f AS (SELECT items, count(*) AS freq FROM s GROUP BY items HAVING count(*) >= (SELECT ceil(0.005 * n) FROM n)),
    r AS (SELECT items, freq, unnest(items) AS c FROM f WHERE len(items) > 1)
    SELECT array_to_string(a.items, ',') AS antecedent, c AS consequent, round(r.freq / a.freq, 9) AS confidence, round(r.freq / n, 9) AS support
    FROM r JOIN f a ON a.items = list_filter(r.items, lambda x: x <> c), n WHERE r.freq / a.freq >= 0.01
    """,
)
def patterns_rules(t: Tables) -> DataFrame:
    rules = FPGrowth(itemsCol="items", minSupport=0.005, minConfidence=0.01).fit(_baskets(t)).associationRules
    return rules.select(
        F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"), F.array_join("consequent", ",").alias("consequent"),
        F.round("confidence", 9).alias("confidence"), F.round("support", 9).alias("support"),
    )


@query(
    "patterns_sequences",
    """
    WITH RECURSIVE q AS (SELECT l_orderkey AS o, l_linenumber AS i, min(l_returnflag) AS f FROM lineitem GROUP BY 1, 2),
    s AS (SELECT o, i, '["' || f || '"]' AS p FROM q UNION SELECT s.o, q.i, s.p || ',["' || q.f || '"]' FROM s JOIN q ON s.o = q.o AND q.i > s.i),
    d AS (SELECT DISTINCT o, p FROM s)
    SELECT '[' || p || ']' AS sequence, count(*)::BIGINT AS freq FROM d GROUP BY p
    HAVING count(*) >= (SELECT ceil(0.1 * count(DISTINCT o)) FROM q)
    """,
)
def patterns_sequences(t: Tables) -> DataFrame:
    """Frequent sequences of return flags by line number (a sequence has at most one step per line number)."""
    steps = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("flag"))
    sequences = steps.groupBy("l_orderkey").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "flag"))), lambda s: F.array(s["flag"])).alias("sequence")
    )
    longest = steps.agg(F.count_distinct("l_linenumber").alias("n")).first()["n"]
    found = PrefixSpan(minSupport=0.1, maxPatternLength=max(1, longest)).findFrequentSequentialPatterns(sequences)
    return found.select(F.to_json("sequence").alias("sequence"), "freq")


@query("tune")
def tune(t: Tables) -> DataFrame:
    """Cross validation and a single split over a small grid."""
    data = _labelled(t).select("features", "label").cache()
    lr = mc.LogisticRegression(maxIter=5)
    grid = mt.ParamGridBuilder().addGrid(lr.regParam, [0.1, 0.01]).build()
    judge = me.BinaryClassificationEvaluator()
    cross = mt.CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=judge, numFolds=2, seed=4).fit(data)
    split = mt.TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=judge, trainRatio=0.8, seed=4).fit(data)
    rows = []
    for name, metrics in (("cross", cross.avgMetrics), ("split", split.validationMetrics)):
        rows += [(name, p[lr.regParam], float(m)) for p, m in zip(grid, metrics)]
    return t.spark.createDataFrame(rows, "way string, reg_param double, metric double")


@query(
    "evaluate",
    """
    WITH p AS (SELECT quality AS y, (n_chars > 500)::INT AS g FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT count(*) FILTER (WHERE y = 1 AND g = 1) AS tp, count(*) FILTER (WHERE y = 0 AND g = 1) AS fp,
      count(*) FILTER (WHERE y = 1 AND g = 0) AS fn, count(*) AS n, count(*) FILTER (WHERE y = g) AS hit,
      avg((y - g) * (y - g)) AS mse, avg(abs(y - g)) AS mae FROM p)
    SELECT 'accuracy' AS metric, round(hit / n, 8) AS value FROM c UNION ALL SELECT 'precision', round(tp / (tp + fp), 8) FROM c
    UNION ALL SELECT 'recall', round(tp / (tp + fn), 8) FROM c UNION ALL SELECT 'rmse', round(sqrt(mse), 8) FROM c
    UNION ALL SELECT 'mae', round(mae, 8) FROM c
    """,
)
def evaluate(t: Tables) -> DataFrame:
    df = t("documents").join(t("labels"), "doc_id").select(
        F.col("quality").cast("double").alias("label"), (F.col("n_chars") > 500).cast("double").alias("prediction")
    ).cache()
    many = me.MulticlassClassificationEvaluator(metricLabel=1.0)
    values = {
        "accuracy": many.evaluate(df, {many.metricName: "accuracy"}),
        "precision": many.evaluate(df, {many.metricName: "precisionByLabel"}),
        "recall": many.evaluate(df, {many.metricName: "recallByLabel"}),
        "rmse": me.RegressionEvaluator(metricName="rmse").evaluate(df),
        "mae": me.RegressionEvaluator(metricName="mae").evaluate(df),
    }
    return t.spark.createDataFrame([(k, round(v, 8)) for k, v in values.items()], "metric string, value double")


@query("evaluate_more")
def evaluate_more(t: Tables) -> DataFrame:
    """Area under the curve, ranking, multi-label and silhouette measures."""
    scored = t("documents").join(t("labels"), "doc_id").select(
        F.col("quality").cast("double").alias("label"), F.col("n_chars").cast("double").alias("rawPrediction")
    )
    kinds = t("events").groupBy("user_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("value") > 50, F.length("event_type").cast("double")))).alias("label"),
        F.array_sort(F.collect_set(F.length("event_type").cast("double"))).alias("prediction"),
    ).cache()
    points = _vectors(t)
    placed = mk.KMeans(k=3, seed=1, maxIter=3).fit(points).transform(points)
    values = {
        "area under curve": me.BinaryClassificationEvaluator().evaluate(scored),
        "mean average precision": me.RankingEvaluator().evaluate(kinds),
        "multi-label f1": me.MultilabelClassificationEvaluator().evaluate(kinds),
        "silhouette": me.ClusteringEvaluator().evaluate(placed),
    }
    return t.spark.createDataFrame([(k, float(v)) for k, v in values.items()], "metric string, value double")


@query(
    "stat_summary",
    """
    SELECT round(avg(l_quantity), 8) AS mean, round(var_samp(l_quantity), 6) AS variance, min(l_discount) AS low, max(l_extendedprice) AS high,
      count(*)::BIGINT AS n, round(corr(l_quantity, l_extendedprice), 8) AS pearson FROM lineitem
    """,
)
def stat_summary(t: Tables) -> DataFrame:
    df = ln.assembled(t("lineitem"), ["l_quantity", "l_discount", "l_extendedprice"])
    s = df.select(ms.Summarizer.metrics("mean", "variance", "min", "max", "count").summary(F.col("features")).alias("s"))
    corr = t("lineitem").agg(F.corr("l_quantity", "l_extendedprice").alias("c")).scalar()
    return s.select(
        F.round(vector_to_array("s.mean")[0], 8).alias("mean"), F.round(vector_to_array("s.variance")[0], 6).alias("variance"),
        vector_to_array("s.min")[1].alias("low"), vector_to_array("s.max")[2].alias("high"), F.col("s.count").alias("n"),
        F.round(corr, 8).alias("pearson"),
    )


@query(
    "stat_spearman",
    """
    WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
        rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
    SELECT round(corr(a::DOUBLE, b::DOUBLE), 6) AS spearman FROM r
    """,
)
def stat_spearman(t: Tables) -> DataFrame:
    df = ln.assembled(t("lineitem"), ["l_quantity", "l_extendedprice"])
    v = vector_to_array("features")
    return rounded(ln.rank_correlation(df.select(v[0].alias("a"), v[1].alias("b")), "a", "b"), 6)


@query(
    "stat_tests",
    """
    WITH c AS (SELECT o_orderpriority AS a, o_orderstatus AS b, count(*) AS n FROM orders GROUP BY 1, 2),
    x AS (SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM c)
    SELECT round(sum((n - e) * (n - e) / e), 6) AS statistic,
      (((SELECT count(DISTINCT a) FROM c) - 1) * ((SELECT count(DISTINCT b) FROM c) - 1))::BIGINT AS freedom FROM x
    """,
)
def stat_tests(t: Tables) -> DataFrame:
    return ln.chi_square(t("orders"), "o_orderpriority", "o_orderstatus").withColumn("statistic", F.round("statistic", 6))


@query("stat_tests_library")
def stat_tests_library(t: Tables) -> DataFrame:
    """Chi-square test per feature and the Kolmogorov-Smirnov test, from the library."""
    src = t("lineitem").select(F.col("l_linenumber").cast("double").alias("l_linenumber"), "l_discount", (F.col("l_quantity") > 25).cast("double").alias("label"), "l_extendedprice")
    chi = ms.ChiSquareTest.test(ln.assembled(src, ["l_linenumber", "l_discount"]), "features", "label").first()
    moments = src.agg(F.avg("l_extendedprice").alias("m"), F.stddev("l_extendedprice").alias("s")).first()
    ks = ms.KolmogorovSmirnovTest.test(src, "l_extendedprice", "norm", moments["m"], moments["s"]).first()
    rows = [("chi line number", float(chi["statistics"][0])), ("chi discount", float(chi["statistics"][1])), ("ks normal", float(ks["statistic"]))]
    return t.spark.createDataFrame(rows, "test string, statistic double")


@query(
    "stat_fit",
    """
    WITH c AS (SELECT o_orderpriority AS v, count(*)::DOUBLE AS n FROM orders GROUP BY 1),
    even AS (SELECT sum(pow(n - t, 2) / t) AS s FROM (SELECT n, sum(n) OVER () / count(*) OVER () AS t FROM c)),
    q AS (SELECT l_linenumber AS v, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1),
    falling AS (SELECT sum(pow(n - t, 2) / t) AS s FROM (SELECT n, sum(n) OVER () * (8 - v) / sum(8 - v) OVER () AS t FROM q)),
    m AS (SELECT avg(o_totalprice) AS a FROM orders),
    r AS (SELECT 1 - exp(-o_totalprice / a) AS f, row_number() OVER (ORDER BY o_totalprice) AS i, count(*) OVER () AS n FROM orders, m)
    SELECT 'even priorities' AS test, round(s, 6) AS statistic, 4::BIGINT AS freedom, round(exp(-s / 2) * (1 + s / 2), 6) AS p_value FROM even
    UNION ALL SELECT 'falling line numbers', round(s, 6), 6, round(exp(-s / 2) * (1 + s / 2 + s * s / 8), 6) FROM falling
    UNION ALL SELECT 'exponential prices', round(max(greatest(i::DOUBLE / n - f, f - (i - 1)::DOUBLE / n)), 6), max(n), 0.0 FROM r
    """,
)
def stat_fit(t: Tables) -> DataFrame:
    """Counts against equal and against falling shares, and prices against an exponential distribution of their mean."""
    even = ln.chi_square_fit(t("orders"), "o_orderpriority")
    shares = t("lineitem").select(F.col("l_linenumber").alias("value")).distinct().withColumn("share", 8 - F.col("value"))
    falling = ln.chi_square_fit(t("lineitem"), "l_linenumber", shares)
    mean = t("orders").agg(F.avg("o_totalprice").alias("a")).scalar()
    prices = ln.kolmogorov_distance(t("orders"), "o_totalprice", lambda v: 1 - F.exp(-v / mean)).withColumnRenamed("n", "freedom")
    named = [df.select(F.lit(n).alias("test"), F.round("statistic", 6).alias("statistic"), F.col("freedom").cast("long").alias("freedom"), F.round("p_value", 6).alias("p_value")) for n, df in (("even priorities", even), ("falling line numbers", falling), ("exponential prices", prices))]
    return named[0].union(named[1]).union(named[2])


@query(
    "stat_density",
    """
    WITH p AS (SELECT unnest([1000.0, 50000.0, 100000.0, 250000.0])::DOUBLE AS point)
    SELECT point, round(avg(exp(-0.5 * pow((o_totalprice - point) / 20000.0, 2)) / (20000.0 * sqrt(2 * pi()))) * 1e6, 8) AS density
    FROM orders, p GROUP BY 1
    """,
)
def stat_density(t: Tables) -> DataFrame:
    out = ln.kernel_density(t("orders"), "o_totalprice", [1000.0, 50000.0, 100000.0, 250000.0], 20000.0)
    return out.select("point", F.round(F.col("density") * 1e6, 8).alias("density"))


@query(
    "matrix_similarities",
    """
    WITH e AS (SELECT vec_id, unnest(range(len(embedding)))::INTEGER AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
    n AS (SELECT i, sqrt(sum(v * v)) AS s FROM e GROUP BY 1),
    g AS (SELECT a.i AS i, b.i AS j, sum(a.v * b.v) AS value FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY 1, 2)
    SELECT g.i, g.j, round(value / (x.s * y.s), 8) AS cosine FROM g JOIN n x ON x.i = g.i JOIN n y ON y.i = g.j
    """,
)
def matrix_similarities(t: Tables) -> DataFrame:
    return rounded(ln.column_similarities(t("embeddings"), "embedding"), 8)


@query("matrix_svd")
def matrix_svd(t: Tables) -> DataFrame:
    return ln.singular_values(t("embeddings"), "embedding", 5)[0]


def _centres_sql(batches: int, decay: float) -> str:
    """Every batch moves the centres of the one before, written out."""
    steps = [
        "v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings)",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, x AS centre, 0.0::DOUBLE AS weight FROM v ORDER BY vec_id LIMIT 3)",
    ]
    for i in range(batches):
        steps += [
            f"a{i} AS (SELECT vec_id, any_value(x) AS x, arg_min(cluster, list_sum(list_transform(list_zip(x, centre), lambda p: pow(p[1] - p[2], 2)))) AS cluster FROM v, c{i} WHERE vec_id % {batches} = {i} GROUP BY vec_id)",
            f"s{i} AS (SELECT cluster, p, sum(x[p]) AS s, count(*) AS n FROM (SELECT cluster, x, unnest(range(1, len(x) + 1)) AS p FROM a{i}) GROUP BY 1, 2)",
            f"m{i} AS (SELECT cluster, list(s ORDER BY p) AS s, any_value(n) AS n FROM s{i} GROUP BY 1)",
            f"c{i + 1} AS MATERIALIZED (SELECT c.cluster, CASE WHEN m.n IS NULL THEN c.centre ELSE list_transform(list_zip(c.centre, m.s), lambda p: (p[1] * weight * {decay} + p[2]) / (weight * {decay} + m.n)) END AS centre, weight * {decay} + coalesce(m.n, 0) AS weight FROM c{i} c LEFT JOIN m{i} m USING (cluster))",
        ]
    return f"WITH {', '.join(steps)} SELECT cluster::INTEGER AS cluster, list_transform(centre, lambda x: round(x, 6)) AS centre, round(weight, 6) AS weight FROM c{batches}"


@query("stream_ml", _centres_sql(4, 0.9))
def stream_ml(t: Tables) -> DataFrame:
    """Centres of streaming k-means over the embeddings, landed in four parts."""
    src = t("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    start = ln.seeds(src, "v", "vec_id", 3)
    stream = runner.stream_files(t.spark, runner.land_parts(src, F.col("vec_id") % 4, 4, 2, "vectors"), 2)
    centres = ln.stream_k_means(stream, "v", start, 0.9, "centres")
    return centres.select("cluster", F.transform("centre", lambda x: F.round(x, 6)).alias("centre"), F.round("weight", 6).alias("weight"))


def _regression_sql(batches: int, steps: int, rate: float) -> str:
    """Gradient steps over every batch, written out."""
    made = ["d AS MATERIALIZED (SELECT l_orderkey, (l_quantity / 50)::DOUBLE AS x, (l_extendedprice / 100000)::DOUBLE AS y FROM lineitem)", "w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for i in range(batches * steps):
        gap = "a + b * x - y"
        made.append(
            f"w{i + 1} AS MATERIALIZED (SELECT any_value(a) - {rate} * avg({gap}) AS a, any_value(b) - {rate} * avg(({gap}) * x) AS b FROM (SELECT * FROM d WHERE l_orderkey % {batches} = {i // steps}), w{i})"
        )
    last = f"w{batches * steps}"
    return f"WITH {', '.join(made)} SELECT 'intercept' AS feature, round(a, 6) AS weight FROM {last} UNION ALL SELECT 'x', round(b, 6) FROM {last}"


@query("stream_ml_regression", _regression_sql(3, 5, 0.5))
def stream_ml_regression(t: Tables) -> DataFrame:
    src = t("lineitem").select("l_orderkey", (F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") / 100000).alias("y"))
    stream = runner.stream_files(t.spark, runner.land_parts(src, F.col("l_orderkey") % 3, 3, 2, "pairs"), 2)
    return ln.stream_regression(stream, ["x"], "y", 0.5, 5, "regression").select("feature", F.round("weight", 6).alias("weight"))


def _descent_sql(rounds: int, rate: float) -> str:
    """The rounds of the descent, written out."""
    steps = ["w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for i in range(rounds):
        gap = "1 / (1 + exp(-(a + b * x))) - y"
        steps.append(f"w{i + 1} AS MATERIALIZED (SELECT any_value(a) - {rate} * avg({gap}) AS a, any_value(b) - {rate} * avg(({gap}) * x) AS b FROM d, w{i})")
    last = f"w{rounds}"
    return (
        "WITH d AS MATERIALIZED (SELECT (l_quantity / 50)::DOUBLE AS x, (l_extendedprice > 50000)::INTEGER::DOUBLE AS y FROM lineitem), "
        + ", ".join(steps)
        + f" SELECT 'intercept' AS feature, round(a, 6) AS weight FROM {last} UNION ALL SELECT 'x', round(b, 6) FROM {last}"
    )


@query("gd_logistic", _descent_sql(15, 4.0))
def gd_logistic(t: Tables) -> DataFrame:
    src = t("lineitem").select((F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") > 50000).alias("y"))
    return ln.logistic_descent(src, ["x"], "y", 15, 4.0).withColumn("weight", F.round("weight", 6))
