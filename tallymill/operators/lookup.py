"""Joins against small tables."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

# Signs by element.
ELEMENT_SIGNS = {
    "fire": ["Овен", "Лев", "Стрелец"],
    "water": ["Рак", "Скорпион", "Рыбы"],
    "earth": ["Телец", "Дева", "Козерог"],
    "air": ["Близнецы", "Весы", "Водолей"],
}


def sign_elements(spark):
    """The 12-row sign dimension."""
    rows = [(sign, element) for element, signs in ELEMENT_SIGNS.items() for sign in signs]
    return spark.createDataFrame(rows, "sign string, element string")


def with_element(df, sign="sign"):
    """Element of each sign, null for an unknown sign. The dimension has 12 rows
    by construction, so broadcasting it is always safe."""
    dim = sign_elements(df.sparkSession).withColumnRenamed("sign", sign)
    return df.join(F.broadcast(dim), sign, "left")


def lookup_join(df, small, on):
    """Left join to another table's columns; null keys match null keys.

    A plain equi-join on purpose: adaptive execution broadcasts the other side
    when its measured bytes are few, and else splits the partitions of a hot key,
    identical rows of it included.
    """
    on = [on] if isinstance(on, str) else list(on)
    named = small.select(*[F.col(c).alias(f"_on_{c}") for c in on],
                         *[c for c in small.columns if c not in on])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return df.join(named, same, "left").drop(*[f"_on_{c}" for c in on])
