"""Evaluation of generated texts from their labels and embeddings."""

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tallymill.functions.hashing import threshold
from tallymill.functions.tags import positive_rate
from tallymill.functions.text import squeeze_spaces
from tallymill.operators.features import SPLIT_SALT, TRAIN_SHARE
from tallymill.operators.lookup import lookup_join

# Prompts and the (top_p, temperature) sets of the sweep.
PROMPTS = ["Лев", "Рыбы", "Козерог", "Телец", "Скорпион", "Близнецы", "Овен", "Весы",
           "Стрелец", "Рак", "Водолей", "Дева"]
SWEEP = [(0.8, 0.7), (0.5, 0.5), (0.1, 0.2)]


def unit_vectors(df, embedding="embedding"):
    """Unit-length ML vector of an array column, as ``_unit``."""
    vectors = df.withColumn("_vec", array_to_vector(F.col(embedding)))
    return Normalizer(p=2.0, inputCol="_vec", outputCol="_unit").transform(vectors).drop("_vec")


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def diversity(df, embedding="embedding", by=()):
    """1 - mean cosine over all ordered pairs of texts, self pairs included.

    The mean of all pairwise cosines of unit vectors is the squared length of
    their mean, so one partial aggregate of a vector per group replaces the
    pairs.
    """
    centres = (unit_vectors(df, embedding).groupBy(*by)
               .agg(F.count(F.lit(1)).alias("n_texts"),
                    vector_to_array(Summarizer.mean(F.col("_unit"))).alias("_c")))
    return centres.select(*by, "n_texts", (1 - dot(F.col("_c"), F.col("_c"))).alias("diversity"))


def text_diversity(df, embedding="embedding", by=()):
    """Every text's 1 - mean cosine to the texts of its group (``diver``)."""
    by = list(by)
    units = unit_vectors(df, embedding)
    centres = units.groupBy(*by).agg(
        vector_to_array(Summarizer.mean(F.col("_unit"))).alias("_c"))
    placed = lookup_join(units, centres, by) if by else units.withColumn("_c", centres.scalar())
    return (placed.withColumn("diver", 1 - dot(vector_to_array("_unit"), F.col("_c")))
            .select(*df.columns, "diver"))


def label_rates(df, by=(), label="grm_label", sentiment="sentiment"):
    """Acceptability and non-negative sentiment percentages."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        positive_rate(label).alias("gramm_corr"), positive_rate(sentiment).alias("positiv"))


def sweep_report(generations, by=("model_name", "top_p", "temperature")):
    """One row per parameter set: acceptability, diversity, sentiment, latency,
    all from a single aggregate."""
    by = list(by)
    out = unit_vectors(generations).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_texts"),
        positive_rate("grm_label").alias("gramm_corr"),
        positive_rate("sentiment").alias("positiv"),
        F.round(F.avg("gen_time"), 4).alias("avg_gen_time"),
        vector_to_array(Summarizer.mean(F.col("_unit"))).alias("_c"))
    diversity_pct = F.round((1 - dot(F.col("_c"), F.col("_c"))) * 100, 2)
    return out.withColumn("diversity", diversity_pct).drop("_c")


def train_pairs(corpus, label="zodiac", text="horo", share=TRAIN_SHARE, salt=SPLIT_SALT):
    """``(split, source_text, target_text, lengths)`` for a text-to-text model.

    White space is squeezed in the source only. The split hashes the pair, so
    equal pairs never sit on both sides.
    """
    side = F.substring(F.md5(F.concat_ws("|", label, text, F.lit(salt))), 1, 8)
    source = squeeze_spaces(label)
    return corpus.select(
        F.when(side < threshold(share), "train").otherwise("val").alias("split"),
        source.alias("source_text"), F.col(text).alias("target_text"),
        F.length(source).alias("source_chars"), F.length(text).alias("target_chars"),
        F.size(F.split(squeeze_spaces(text), " ")).alias("target_words"))
