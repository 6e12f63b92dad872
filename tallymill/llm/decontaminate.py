"""Benchmark items in documents, also with other numbers, names or units.

Texts become word templates: numbers, units after numbers, and capitalised words
inside sentences become typed placeholders; other words are lower-cased.  Windows
of template words are hashed and joined with the windows of the benchmark, and so
are the windows of the words as they stand, so that a copy is found however few
of its words are ordinary.  Hits
on one alignment of a document with an item are held together: they must cover
enough words, and each placeholder value of the item must stand for one and the
same value of the document everywhere, and the other way round.  Enough words in a
row that stand there word for word count whatever the placeholders elsewhere.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallymill.session import materialise

WINDOW = 8
MIN_WORDS = 13
MIN_LITERALS = 4
FILTER_BITS = 1 << 23

# Units of measure that become placeholders after a number.
UNITS = """% percent km m cm mm mi mile miles ft feet foot inch inches yd yard yards kg g mg lb lbs oz pound pounds ton tons
l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks
month months year years mph kmh kph hz khz mhz ghz kb mb gb tb w kw mw v kv a ma j kj cal kcal n pa kpa bar c f k
dollar dollars cent cents euro euros usd eur gbp"""
_OTHER, _LETTER, _DIGIT, _MARK, _PERCENT, _APOSTROPHE, _DOT, _COMMA = range(8)
_BLOCK_CHARS = 1 << 19
_PIECE_CHARS = 1 << 20
_SPACES = " \t\r\f\v\u00a0\u2009\u3000"
_MULTIPLIERS = np.random.default_rng(5).integers(1 << 62, 1 << 63, 65, dtype=np.uint64) | np.uint64(1)
_TABLES = {}


def _characters():
    """Class and lower case of every code point.

    Built once; functions that are sent to tasks take the filled tables along, so the
    driver fills them first."""
    if not _TABLES:
        kinds, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalnum():
                kinds[code] = _DIGIT if c.isdecimal() else _LETTER
                low = c.lower()
                if len(low) == 1:
                    lower[code] = ord(low)
        for kind, members in ((_MARK, "!?:;\n\"“”«»([|>*#$&"), (_PERCENT, "%"), (_APOSTROPHE, "'’"), (_DOT, "."), (_COMMA, ",")):
            kinds[[ord(c) for c in members]] = kind
        _TABLES["kinds"], _TABLES["lower"] = kinds, lower
    return _TABLES["kinds"], _TABLES["lower"]


def _mix(hashes):
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return hashes ^ (hashes >> np.uint64(29))


def _join_numbers(kinds):
    """Dots and commas between digits become digits; other dots end sentences."""
    at = np.flatnonzero((kinds == _DOT) | (kinds == _COMMA))
    if len(at):
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        last = np.append(first[1:], len(at)) - 1
        padded = np.concatenate([[_OTHER], kinds, [_OTHER]])
        inside = (padded[at[first]] == _DIGIT) & (padded[at[last] + 2] == _DIGIT)
        inside = np.repeat(inside, last - first + 1)
        kinds[at] = np.where(inside, _DIGIT, np.where(kinds[at] == _DOT, _MARK, _OTHER))
    at = np.flatnonzero(kinds == _APOSTROPHE)
    if len(at):
        padded = np.concatenate([[_OTHER], kinds, [_OTHER]])
        kinds[at] = np.where((padded[at] == _LETTER) & (padded[at + 2] == _LETTER), _LETTER, _OTHER)


def _word_hashes(codes, starts, lengths):
    """Hash of each run of lower-cased code points."""
    ends = np.cumsum(lengths)
    before = ends - lengths
    place = np.arange(ends[-1]) - np.repeat(before, lengths)
    letters = codes[place + np.repeat(starts, lengths)]
    sums = np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[place & 63], before)
    return _mix(sums + lengths.astype(np.uint64) * _MULTIPLIERS[64])


def _fixed(name):
    codes = np.frombuffer(name.encode("utf-32-le"), np.uint32)
    return _word_hashes(codes, np.array([0]), np.array([len(codes)]))[0]


NUMBER, UNIT, NAME = (_fixed("\0" + name) for name in ("number", "unit", "name"))
_UNIT_HASHES = np.array(sorted(_fixed(unit) for unit in UNITS.split() if unit != "%"), np.uint64)


def template(text):
    """(starts, ends, hashes, literal) of the words of a text: where each stands, the hash of the
    word or of its placeholder, and whether it stands for itself.

    Words are runs of letters, with apostrophes inside; numbers are runs of digits,
    with dots and commas inside. A capitalised word is a name unless it begins the
    text or follows a mark that may end a sentence; a unit or percent sign counts as
    one right after a number, and other percent signs are marks."""
    return _words(text)[:4]


def _words(text):
    """What ``template`` gives, the hash of each word as it stands, in lower case, and whether it may
    be a name that opens a text or sentence."""
    table, lower = _characters()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return (*np.zeros((2, 0), np.int64), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.uint64), np.zeros(0, bool))
    kinds = table[codes]
    _join_numbers(kinds)
    starts = np.concatenate([[0], np.flatnonzero(kinds[1:] != kinds[:-1]) + 1])
    kind, ends = kinds[starts], np.append(starts[1:], len(kinds))
    token = np.flatnonzero((kind == _LETTER) | (kind == _DIGIT) | (kind == _PERCENT))
    if not len(token):
        return starts[:0], ends[:0], np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.uint64), np.zeros(0, bool)
    marked = np.diff(np.cumsum(kind == _MARK)[token], prepend=-1) > 0
    starts, ends, kind = starts[token], ends[token], kind[token]
    before = np.where(marked, _MARK, np.concatenate([[_MARK], kind[:-1]]))
    low = lower[codes]
    plain = _word_hashes(low, starts, ends - starts)
    hashes = np.where(kind == _DIGIT, NUMBER, plain)
    words = np.flatnonzero(kind == _LETTER)
    name, opens = np.zeros((2, len(token)), bool)
    unit = (kind == _PERCENT) & (before == _DIGIT)
    if len(words):
        lengths = ends[words] - starts[words]
        capitals = np.concatenate([[0], np.cumsum(low != codes)])
        head = low[starts[words]] != codes[starts[words]]
        alone = capitals[ends[words]] - capitals[starts[words]] == 1
        capital, inside = head & alone & (lengths > 1), (before[words] != _MARK) & (before[words] != _PERCENT)
        name[words], opens[words] = capital & inside, capital & ~inside
        measured = words[before[words] == _DIGIT]
        unit[measured] = np.isin(hashes[measured], _UNIT_HASHES)
    hashes[name], hashes[unit] = NAME, UNIT
    kept = (kind != _PERCENT) | unit
    return starts[kept], ends[kept], hashes[kept], ~(name | unit | (kind == _DIGIT))[kept], plain[kept], opens[kept]


def runs(hashes, length):
    """Hashes of all runs of ``length`` word hashes."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    mixed = np.full(n, length, np.uint64)
    for k in range(length):
        mixed = _mix(mixed ^ hashes[k:k + n])
    return mixed


def _pieces(text):
    """A text cut into pieces of bounded size, after a line end or sentence where there is one, else
    after white space; only a word longer than a piece is cut itself."""
    at = 0
    while len(text) - at > _PIECE_CHARS:
        end = at + _PIECE_CHARS
        cut = max(text.rfind("\n", at, end) + 1, text.rfind(". ", at, end) + 2)
        if cut <= at + 1:
            cut = max(text.rfind(space, at, end) for space in _SPACES) + 1
        cut = cut if cut > at else end
        yield at, text[at:cut]
        at = cut
    yield at, text[at:]


def _templates(texts):
    """(text number, starts, ends, hashes, literal, plain, opens) of the words of blocks of consecutive
    texts; a text is never cut between blocks."""
    block, held = [], 0
    for i, text in enumerate(texts):
        if len(text) > _PIECE_CHARS:
            parts = [(at, *_words(piece)) for at, piece in _pieces(text)]
            starts, ends = (np.concatenate([p[0] + p[k] for p in parts]) for k in (1, 2))
            yield (np.full(len(starts), i), starts, ends,
                   *(np.concatenate([p[k] for p in parts]) for k in range(3, len(parts[0]))))
            continue
        if held and held + len(text) > _BLOCK_CHARS:
            yield _block(block)
            block, held = [], 0
        block.append((i, text))
        held += len(text) + 1
    if block:
        yield _block(block)


def _block(block):
    numbers = np.array([i for i, _ in block])
    first = np.concatenate([[0], np.cumsum([len(text) + 1 for _, text in block])[:-1]])
    starts, ends, *rest = _words("\n".join(text for _, text in block))
    of = np.searchsorted(first, starts, side="right") - 1
    return numbers[of], starts - first[of], ends - first[of], *rest


def _readings(hashes, literal, plain, opens, length):
    """(first words, hashes, stand, opened) of the readings of all windows; ``stand`` tells of each
    word of a window whether it stands for itself, or is one such array for all words.

    A window is read with placeholders, if enough ordinary words remain, and word for
    word.  A capitalised word that opens a sentence may be an ordinary word or a name,
    so a window is also read with every choice of its openers as names."""
    least = min(MIN_LITERALS, length)
    ordinary, openers = (np.concatenate([[0], np.cumsum(flags)]) for flags in (literal, opens))
    n_ordinary, n_openers = ordinary[length:] - ordinary[:-length], openers[length:] - openers[:-length]
    mixed = runs(hashes, length)
    at = np.flatnonzero(n_ordinary >= least)
    yield at, mixed[at], literal, False
    # A window of ordinary words only has one and the same hash in both readings.
    mixed = runs(plain, length)
    at = np.flatnonzero(n_ordinary < length)
    yield at, mixed[at], np.ones(len(plain), bool), False
    n_names = np.minimum(n_openers, n_ordinary - least)
    for count in np.unique(n_openers[n_names > 0]).tolist():
        at = np.flatnonzero((n_openers == count) & (n_names > 0))
        place = at[:, None] + np.arange(length)
        words, itself, opening = hashes[place], literal[place], opens[place]
        ordinal = np.where(opening, np.cumsum(opening, axis=1) - 1, length)
        most = int(n_names[at].max())
        for choice in range(1, 1 << count):
            if choice.bit_count() > most:
                continue
            fits = n_names[at] >= choice.bit_count()
            named = (choice >> ordinal[fits]) & 1 == 1
            chosen = np.where(named, NAME, words[fits])
            mixed = np.full(len(chosen), length, np.uint64)
            for k in range(length):
                mixed = _mix(mixed ^ chosen[:, k])
            yield at[fits], mixed, itself[fits] & ~named, True


def _windows(texts, lengths, wanted=None):
    """(text number, hash, position, length, opened, values) of the readings of all windows; ``opened``
    tells that an opener is read as a name, and a value is empty for a word that stands
    for itself.  ``wanted`` keeps only hashes whose bit is set in a filter."""
    for owner, starts, ends, *words in _templates(texts):
        first = np.searchsorted(owner, owner)
        for length in lengths:
            if len(owner) < length:
                continue
            for begin, mixed, stand, opened in _readings(*words, length):
                chosen = owner[begin + length - 1] == owner[begin]
                if wanted is not None:
                    bits = (mixed & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                    chosen &= (wanted[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1
                for i in np.flatnonzero(chosen).tolist():
                    at = int(begin[i])
                    text, itself = texts[owner[at]], stand[i] if stand.ndim == 2 else stand[at:at + length]
                    yield (int(owner[at]), int(mixed[i].view(np.int64)), int(at - first[at]), length, opened,
                           ["" if alone else text[starts[k]:ends[k]] for k, alone in zip(range(at, at + length), itself)])


def item_windows(benchmark, window=WINDOW):
    """``hash, item_id, item_pos, length, item_opened, item_values, item_words``; an item shorter than the window is
    one window of its own length.  Items with equal texts give windows once, under their least id."""
    _characters()
    items = benchmark.where("text is not null").groupBy("text").agg(F.min("item_id").alias("item_id"))
    schema = "item_id long, hash long, item_pos int, length int, item_opened boolean, item_values array<string>, item_words int"

    def cut(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch["item_id"], batch["text"]):
                n = len(template(text)[0])
                if n:
                    rows += [(item, *found, n) for _, *found in _windows([text], [min(n, window)])]
            yield pd.DataFrame(rows, columns=["item_id", "hash", "item_pos", "length", "item_opened", "item_values",
                                               "item_words"]
                               ).astype({"item_id": "Int64"})

    return items.mapInPandas(cut, schema)


def _filter(windows):
    """Bit filter of fixed size over the hashes of the benchmark's windows."""
    position = F.col("hash").bitwiseAND(FILTER_BITS - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), position.bitwiseAND(31).cast("int"))
    words = (windows.select(F.shiftright(position, 5).alias("word"), bit.alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in words:
        out[r["word"]] = r["bits"]
    return out.view(np.uint8)


def hits(docs, windows):
    """``doc_id, text_hash, doc_pos, doc_opened, doc_values`` with the item's columns, for windows of documents
    that equal a window of the benchmark.  A document's windows pass a bit filter of
    fixed size (the only thing broadcast) before they are shuffled."""
    _characters()
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())
    wanted = docs.sparkSession.sparkContext.broadcast(_filter(windows))
    schema = "doc_id long, text_hash long, hash long, doc_pos int, length int, doc_opened boolean, doc_values array<string>"

    def cut(batches):
        bits = wanted.value
        for batch in batches:
            ids, keys = batch["doc_id"].tolist(), batch["text_hash"].tolist()
            rows = [(ids[i], keys[i], *found) for i, *found in _windows(batch["text"].tolist(), lengths, bits)]
            yield pd.DataFrame(rows, columns=["doc_id", "text_hash", "hash", "doc_pos", "length", "doc_opened", "doc_values"]
                               ).astype({"doc_id": "Int64"})

    found = (docs.where("text is not null")
             .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
             .mapInPandas(cut, schema))
    return found.join(windows, ["hash", "length"])


def _longest(at, length):
    """Column of the most consecutive words that windows at sorted positions cover."""
    zero = F.lit(0).cast("int")
    start = F.struct(zero.alias("first"), zero.alias("end"), zero.alias("best"))

    def step(run, p):
        first = F.when(p <= run["end"], run["first"]).otherwise(p)
        end = p + F.col(length)
        return F.struct(first.alias("first"), end.alias("end"), F.greatest(run["best"], end - first).alias("best"))

    return F.aggregate(at, start, step, lambda run: run["best"])


def contaminated(docs, benchmark, window=WINDOW, min_words=MIN_WORDS):
    """``doc_id, text_hash, item_id, n_windows, item_from, item_to, doc_from, changed``: alignments of a
    document with an item that cover at least ``min_words`` words of it (all, if it has
    fewer) with consistent placeholders.  Windows that overlap or adjoin cover all words
    between them.  An alignment counts if it holds with the openers of sentences as
    ordinary words, or else as names where that fits, or else if ``min_words`` words stand word for
    word in a row, whatever the placeholders elsewhere on the alignment.  ``changed`` tells that some placeholder has another value than in the
    item.  Clean documents give no row.

    Items with equal texts count once, under the least id.  Null, empty and wordless
    texts match nothing.  Repeated rows of a document are one document; a null
    ``doc_id`` keeps its rows (told apart by ``text_hash``).  Other columns are not
    read.  An empty table on either side gives no rows.
    """
    windows = materialise(item_windows(benchmark, window), "benchmark-windows")
    same = F.arrays_zip("item_values", "doc_values")
    strict = ~(F.col("item_opened") | F.col("doc_opened"))
    places = lambda kept: F.array_sort(F.collect_set(F.when(kept, F.col("item_pos"))))
    values = lambda kept: F.array_distinct(F.flatten(F.collect_set(F.when(kept, F.col("pairs")))))
    aligned = (hits(docs, windows)
               .withColumn("pairs", F.filter(same, lambda p: (p["item_values"] != "") | (p["doc_values"] != "")))
               .withColumn("literal", strict & (F.col("item_values") == F.col("doc_values")))
               .groupBy("doc_id", "text_hash", "item_id", "item_words", (F.col("doc_pos") - F.col("item_pos")).alias("shift"))
               .agg(F.struct(places(strict).alias("at"), values(strict).alias("pairs")).alias("strict"),
                    F.struct(places(F.lit(True)).alias("at"), values(F.lit(True)).alias("pairs")).alias("any"),
                    F.struct(places(F.col("literal")).alias("at"), values(F.col("literal")).alias("pairs")).alias("literal"),
                    F.max("length").alias("length")))

    def holds(reading):
        at, pairs = reading["at"], reading["pairs"]
        covered = F.greatest(F.size(at) + F.col("length") - 1, _longest(at, "length"))
        one_to_one = [F.size(F.array_distinct(F.transform(pairs, lambda p: p[side]))) == F.size(pairs)
                      for side in ("item_values", "doc_values")]
        return (F.size(at) > 0) & (covered >= F.least(F.lit(min_words), "item_words")) & one_to_one[0] & one_to_one[1]

    in_a_row = _longest(F.col("literal.at"), "length") >= F.least(F.lit(min_words), "item_words")
    found = (F.when(holds(F.col("strict")), F.col("strict")).when(holds(F.col("any")), F.col("any"))
             .when(in_a_row, F.col("literal")))
    return (aligned.withColumn("found", found).where("found is not null")
            .select("doc_id", "text_hash", "item_id", F.size("found.at").cast("bigint").alias("n_windows"),
                    F.array_min("found.at").alias("item_from"), (F.array_max("found.at") + F.col("length")).alias("item_to"),
                    (F.array_min("found.at") + F.col("shift")).alias("doc_from"),
                    F.exists("found.pairs", lambda p: p["item_values"] != p["doc_values"]).alias("changed")))


def keep_clean(docs, benchmark, window=WINDOW, min_words=MIN_WORDS):
    """The rows of ``docs``, with their columns, that ``contaminated`` does not name."""
    found = contaminated(docs, benchmark, window, min_words).select(
        F.col("doc_id").alias("__tm_id"), F.col("text_hash").alias("__tm_hash")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.select(*columns, F.xxhash64(F.col("text")).alias("__tm_text"))
    same = (F.col("__tm_text") == F.col("__tm_hash")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("__tm_id"))
    return named.join(found, same, "left_anti").select(*columns)
