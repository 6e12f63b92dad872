"""Text column functions: cutting, allow-lists, ordered literal removal."""

from functools import reduce

from pyspark.sql import Column, functions as F

NBSP = "\u00a0"

# Characters kept by each cleaning step (negated classes).
CORPUS_ALLOW = "[^а-яА-ЯЁё !.,:?;«»-]+"
EVAL_ALLOW = "[^а-яА-ЯЁё !.,:?;«»]"
BOT_ALLOW = "[^а-яА-ЯЁё !.,:?;-]"
# The same idea for any script.
ANY_LETTER_ALLOW = r"[^\p{L} !.,:?;«»-]+"

# Punctuation artefacts removed from generated text, in order.
EVAL_SYMBOLS = ["..", ",.", "?.", " , ", " . ", " : ", ".:", ":.", "«. »",
                "??", "?!", ".?", "? .", "? ."]
BOT_SYMBOLS = ["..", ",.", "?.", " , ", " . ", " : ", ".:", ":.", "??", "?!",
               ".?", "? .", "? .", " .", ",,", "::", "  ", ".и", ".или", ".!",
               ".,"]
EVAL_PASSES = 2
BOT_PASSES = 3

# Fixed value: end-of-sequence marker left by the text generator.
END_MARKER = "</s>"

# Unicode white space, as a regex class body (Java's \s is ASCII only) and as text.
SPACES = (r"\t\n\x0b\f\r \x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029"
          r"\u202f\u205f\u3000")
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _col(c):
    return c if isinstance(c, Column) else F.col(c)


def first_part(c, separator=NBSP):
    """Text before the first separator (the whole text if there is none)."""
    return F.substring_index(_col(c), separator, 1)


def last_token(c, separator=" "):
    return F.substring_index(_col(c), separator, -1)


def remove_literal(c, literal):
    return F.replace(_col(c), F.lit(literal), F.lit(""))


def keep_allowed(c, disallowed_class=CORPUS_ALLOW):
    """Delete every character the negated class matches."""
    return F.regexp_replace(_col(c), disallowed_class, "")


def remove_symbols(c, symbols, passes=1):
    """Delete literals one after another, the whole list ``passes`` times.

    Order and pass count change the result: each deletion can create or destroy
    a later match.
    """
    return reduce(remove_literal, list(symbols) * passes, _col(c))


def strip(c):
    """Trim every kind of white space at both ends."""
    return F.btrim(_col(c), F.lit(SPACE_CHARS))


def cut_at_marker(c, marker=END_MARKER):
    """Text before the marker, stripped; untouched where the marker is absent."""
    c = _col(c)
    return F.when(F.contains(c, F.lit(marker)),
                  strip(F.substring_index(c, marker, 1))).otherwise(c)


def squeeze_spaces(c):
    """One blank between words, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), f"[{SPACES}]+", " "))


def contains_any(c, needles):
    """True where any of the literals occurs."""
    return reduce(lambda a, b: a | b,
                  [F.contains(_col(c), F.lit(n)) for n in needles])


def clean_corpus_text(c, disallowed_class=CORPUS_ALLOW):
    """Corpus cleaning chain: cut at nbsp, drop newlines, apply the allow-list."""
    c = first_part(c)
    c = remove_literal(c, "\n")
    c = remove_literal(c, NBSP)   # no effect after the cut; kept for other separators
    return keep_allowed(c, disallowed_class)


def clean_generated(c, preset="eval", disallowed_class=None):
    """Generated-text cleaning chain.

    The end marker is cut first: the allow-list would delete its brackets and
    leave nothing to find.
    """
    allow, symbols, passes = {
        "eval": (EVAL_ALLOW, EVAL_SYMBOLS, EVAL_PASSES),
        "bot": (BOT_ALLOW, BOT_SYMBOLS, BOT_PASSES),
    }[preset]
    c = keep_allowed(cut_at_marker(c), disallowed_class or allow)
    return remove_symbols(c, symbols, passes)
