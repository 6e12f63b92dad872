"""Message routing: the first matching rule names the intent."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from tallymill.functions.text import contains_any


@dataclass(frozen=True)
class Route:
    """``how`` is ``exact``, ``contains`` or ``contains_lower`` (text lower-cased)."""
    intent: str
    how: str
    needles: tuple


# Menu captions, signs with their symbols, and greetings, in the
# order in which they are tried.
BOT_ROUTES = (
    Route("menu_fire", "exact", ("🔥Знаки Огня",)),
    Route("menu_water", "exact", ("💧Знаки Воды",)),
    Route("menu_earth", "exact", ("🌍Знаки Земли",)),
    Route("menu_air", "exact", ("🎈Знаки Воздуха",)),
    Route("back", "exact", ("Назад",)),
    Route("sign", "contains", (
        "♈Овен", "♌Лев", "♐Стрелец", "♋Рак", "♏Скорпион", "♓Рыбы",
        "♉Телец", "♍Дева", "♑Козерог", "♊Близнецы", "♎Весы", "♒Водолей")),
    Route("greeting", "contains_lower", (
        "/hello", "привет", "hello", "hi", "privet", "hey",
        "добрый день", "доброе утро", "добрый вечер")),
)


def _matches(text, lowered, route):
    if route.how == "exact":
        return F.col(text).isin(list(route.needles))
    if route.how == "contains":
        return contains_any(text, route.needles)
    if route.how == "contains_lower":
        return contains_any(lowered, route.needles)
    raise ValueError(f"unknown match kind {route.how!r}")


def route(df, text="text", routes=BOT_ROUTES, fallback="fallback"):
    """Add ``intent``: an ordered ``when`` chain over the routes."""
    chain = F
    for r in routes:
        chain = chain.when(_matches(text, "_lowered", r), r.intent)
    # Lower-cased once per row, not once per needle.
    return (df.withColumn("_lowered", F.lower(text))
            .withColumn("intent", chain.otherwise(fallback)).drop("_lowered"))


def intent_counts(routed, *by):
    return routed.groupBy(*by, "intent").agg(F.count(F.lit(1)).alias("n"))
