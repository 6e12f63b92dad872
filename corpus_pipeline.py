"""From raw documents to sharded training text.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a
DataFrame, which is written as Parquet and read again as the next one's input.
All but the last return the columns of their input.  Null and empty texts, null
ids, repeated rows and further columns are treated as the operators' docstrings
say; an empty table passes through as an empty one.
"""

from tallymill.llm import decontaminate, mixing, quality, sharding, simhash
from tallymill.llm.common import table
from tallymill.session import materialise


def good_quality(spark, docs, sf_dir):
    """Documents that the line field does not reject."""
    field = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, field)


def one_of_each(spark, docs, sf_dir):
    """One document of each SimHash group: the least id."""
    return simhash.keep_one(docs)


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark, docs, sf_dir):
    """Documents repeated towards the sources' target weights, in shuffled order."""
    names = ("__tm_copy", "__tm_rate", "__tm_shuffle_key")
    return mixing.mix(docs, names=names).drop(*names)


def sharded(spark, docs, sf_dir):
    """Every row with its shard and its slot there."""
    return sharding.assign(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

# The first stages learn a model and group by hashes that SQL lacks; tests compare with plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The sharded training table of the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
