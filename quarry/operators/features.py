"""Feature preparation: indexing, assembling, scaling, text features and
deterministic splits.

Two kinds of functions live here:

* thin, explicit configurations of ``pyspark.ml`` transformers with the
  defaults the notebook jobs rely on (``StringIndexer`` frequency order,
  ``VectorAssembler``, ``StandardScaler`` with mean and std, ``Tokenizer``,
  ``StopWordsRemover``, ``HashingTF``, ``IDF``);
* relational twins of the same maths (term frequencies, document
  frequencies, IDF, standardisation) written with DataFrame operations,
  used where a table result is wanted and as cross-checks.
"""

from __future__ import annotations

from pyspark.ml.feature import (HashingTF, IDF, StandardScaler, StopWordsRemover, StringIndexer,
                                Tokenizer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.expressions import hash_bucket100

# The skill keywords flagged in job titles, in their order.
SKILL_KEYWORDS = ["developer", "engineer", "designer", "writer", "marketing",
                  "data", "analysis", "python", "java", "javascript", "react",
                  "sql", "aws", "azure", "web", "mobile", "app", "software"]
# Fixed value: characters kept when cleaning a title.
TITLE_KEEP_PATTERN = r"[^a-zA-Z\s]"


# Spark ML's default English stop words, in their order
# (equal to StopWordsRemover.loadDefaultStopWords("english")).
ENGLISH_STOP_WORDS = tuple((
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "a an the and but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now i'll you'll "
    "he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're "
    "they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't "
    "doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's "
    "how's let's ought that's there's what's when's where's who's why's would "
).split())


# ------------------------------------------------------------- ml stages
def string_indexer(input_col: str, output_col: str, handle_invalid: str = "keep") -> StringIndexer:
    """Frequency-descending index (ties alphabetical). ``keep`` gives unseen
    values the extra index n instead of failing the scoring job."""
    return StringIndexer(inputCol=input_col, outputCol=output_col, handleInvalid=handle_invalid,
                         stringOrderType="frequencyDesc")


def assembler(input_cols: list[str], output_col: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=input_cols, outputCol=output_col, handleInvalid=handle_invalid)


def index_strings_then_assemble(df: DataFrame, input_cols: list[str], output_col: str = "features",
                                handle_invalid: str = "keep"):
    """Stages that assemble ``input_cols`` after indexing every string
    column among them (a text column cannot enter a numeric assembler)."""
    stages, cols = [], []
    for c in input_cols:
        if dict(df.dtypes)[c] == "string":
            stages.append(string_indexer(c, f"{c}__idx", handle_invalid))
            cols.append(f"{c}__idx")
        else:
            cols.append(c)
    stages.append(assembler(cols, output_col, handle_invalid))
    return stages


def scaler(input_col: str, output_col: str) -> StandardScaler:
    """(x - mean) / sample standard deviation per component."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True)


def text_stages(input_col: str, num_features: int = 1000, idf: bool = True):
    """Tokenizer → StopWordsRemover → HashingTF(num_features) [→ IDF]."""
    st = [Tokenizer(inputCol=input_col, outputCol="words"),
          StopWordsRemover(inputCol="words", outputCol="filtered_words",
                           stopWords=list(ENGLISH_STOP_WORDS)),
          HashingTF(inputCol="filtered_words", outputCol="raw_features", numFeatures=num_features)]
    if idf:
        st.append(IDF(inputCol="raw_features", outputCol="features"))
    return st


def vector_columns(vec: str, names: list[str]) -> list[Column]:
    arr = vector_to_array(F.col(vec))
    return [arr[i].alias(n) for i, n in enumerate(names)]


# ------------------------------------------------------ relational twins
def standardize(df: DataFrame, cols: list[str], suffix: str = "_z") -> DataFrame:
    """Relational ``StandardScaler(withMean, withStd)``: fit = one global
    aggregate (2 numbers per column reach the driver), transform = a
    projection with those numbers as literals."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    z = []
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        z.append((F.lit(0.0) if not s else (F.col(c) - F.lit(m)) / F.lit(s)).alias(f"{c}{suffix}"))
    return df.select(*df.columns, *z)


def clean_title(c: Column) -> Column:
    """Lower-case letters and whitespace only."""
    return F.lower(F.regexp_replace(c, TITLE_KEEP_PATTERN, ""))


def keyword_flags(df: DataFrame, text_col: str = "clean_title", keywords=SKILL_KEYWORDS,
                  mode: str = "substring") -> DataFrame:
    """0/1 flag per keyword, all in ONE projection. ``substring`` matches
    anywhere (so "java" fires on "javascript"); ``token`` matches whole
    whitespace-separated words."""
    t = F.col(text_col)
    if mode == "substring":
        flags = [F.when(t.contains(k), 1).otherwise(0).alias(f"has_{k}") for k in keywords]
    elif mode == "token":
        words = F.split(t, r"\s+")
        flags = [F.when(F.array_contains(words, k), 1).otherwise(0).alias(f"has_{k}") for k in keywords]
    else:
        raise ValueError(mode)
    return df.select("*", *flags)


def tokenize(c: Column) -> Column:
    """Lower-case and split on single whitespace characters, keeping
    leading and inner empty tokens and dropping trailing ones (the
    ``Tokenizer`` rule)."""
    return F.split(F.regexp_replace(F.lower(c), r"\s+$", ""), r"\s")


def term_table(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """(id, term, tf) — one row per distinct term of a document.

    ``explode_outer`` + a filter on the generated column: plain ``explode``
    makes the optimizer infer ``size(tokens) > 0`` and push it under
    upstream shuffles, evaluating the whole tokenization twice."""
    return (df.select(id_col, F.explode_outer(tokens_col).alias("term"))
              .filter(F.col("term").isNotNull())
              .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def tfidf(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """Relational TF-IDF: ``idf = ln((N + 1) / (df + 1))``, ``tfidf = tf ·
    idf`` (the ``IDF`` estimator's formula, minDocFreq 0). The words are
    shuffled once, by term: a term's (doc, term) counts and its document
    frequency are both taken where its words lie, without a join. A hot
    term's rows are sorted and counted in one task and may spill."""
    n_docs = df.select(F.countDistinct(id_col)).scalar()  # part of the query, no job while planning
    words = (df.select(id_col, F.explode_outer(tokens_col).alias("term"))
               .filter(F.col("term").isNotNull()).repartition("term"))
    tt = words.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    j = tt.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("term")))
    idf = F.log((n_docs + 1) / (F.col("df") + 1))
    return j.select(id_col, "term", "tf", "df", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf"))


def hash_split(df: DataFrame, key: Column, train_pct: int = 70) -> dict[str, DataFrame]:
    """Deterministic train/test split on a row key: the same rows land in
    the same side for every partitioning and every run."""
    b = hash_bucket100(key)
    return {"train": df.filter(b < train_pct), "test": df.filter(b >= train_pct)}


def distance_from(lat: Column, lng: Column, center=(20.666378, -103.34882)) -> Column:
    """Planar distance from a fixed centre (degrees)."""
    return F.sqrt(F.pow(lat - F.lit(center[0]), 2) + F.pow(lng - F.lit(center[1]), 2))
