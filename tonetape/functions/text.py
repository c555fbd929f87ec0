"""Expressions over filing text: dates, tone counts, paragraphs, pieces.

All but the cutting into chunks and pieces stays inside the JVM; that goes through Arrow
batches.  Texts are expected to use "\\n" as line end; `read_filings` sees to that.
"""

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tonetape.schema import NEGATIVE_WORDS, POSITIVE_WORDS

#: Bytes of texts that are strings at a time, about, while they are cut up.
SLICE = 1 << 20
# The characters that count as white space.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = f"[{SPACES}]"
# The date patterns.
HEADER_DATE = r": (\d{8})$"
EIGHT_DIGITS = r"(\d{8})"
SLASH_DATE = r"(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
DATE_MARKS = ("FILING-DATE", "ACCEPTANCE-DATETIME")
BLANK_LINE = f"\n{SPACE}*\n"
# Spellings of the two signed classes in scorer labels.
POSITIVE_LABELS = ("POSITIVE", "positive", "2", "LABEL_2")
NEGATIVE_LABELS = ("NEGATIVE", "negative", "0", "LABEL_0")


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(c) -> Column:
    return F.btrim(_col(c), F.lit(SPACES))


def quarter_of(month) -> Column:
    return (F.floor((_col(month) - 1) / 3) + 1).cast("int")


def _year_month(digits: Column) -> Column:
    """yyyyMMdd text -> (year, month) struct, NULL for an empty match."""
    return F.when(
        digits != "",
        F.struct(
            F.substring(digits, 1, 4).cast("int").alias("year"),
            F.substring(digits, 5, 2).cast("int").alias("month"),
        ),
    )


def header_date(text) -> Column:
    """(year, month) from the first line, NULL when it does not end in ': yyyyMMdd'."""
    line = strip(F.substring_index(_col(text), "\n", 1))
    return _year_month(F.regexp_extract(line, HEADER_DATE, 1))


def filing_date(text, lines: int = 30) -> Column:
    """(year, month) from the first lines: header form, marked line, then M/D/YYYY.

    Only the head of the text is split.  A mark counts when the *next* line
    carries eight digits.
    """
    head = F.slice(F.split(_col(text), "\n", lines + 1), 1, lines)
    return let(F.transform(head, strip), _first_date)


def _first_date(head: Column) -> Column:
    def first(found):
        return F.get(F.filter(found, lambda m: m.isNotNull()), 0)

    def on_line(x):
        return _year_month(F.regexp_extract(x, HEADER_DATE, 1))

    def below(x, i):
        marked = reduce(lambda a, b: a | b, [F.contains(x, F.lit(m)) for m in DATE_MARKS])
        under = F.coalesce(F.get(head, i + 1), F.lit(""))
        return F.when(marked, _year_month(F.regexp_extract(under, EIGHT_DIGITS, 1)))

    def slashed(x):
        return F.when(
            F.regexp_extract(x, SLASH_DATE, 3) != "",
            F.struct(
                F.regexp_extract(x, SLASH_DATE, 3).cast("int").alias("year"),
                F.regexp_extract(x, SLASH_DATE, 1).cast("int").alias("month"),
            ),
        )

    return F.coalesce(*[first(F.transform(head, f)) for f in (on_line, below, slashed)])


def in_month_range(year, month, start: str, end: str) -> Column:
    """Does the first of the month lie in [start, end]?  Impossible months do not."""
    year, month = _col(year), _col(month)
    ok = month.between(1, 12) & year.between(1, 9999)
    first = F.when(ok, F.make_date(year, month, F.lit(1)))
    return F.coalesce(
        first.between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False)
    )


def _hits(low: Column, words) -> Column:
    size = F.octet_length(low)
    per_word = [
        (size - F.octet_length(F.replace(low, F.lit(w), F.lit("")))) / len(w.encode())
        for w in (word.lower() for word in words)
    ]
    return reduce(lambda a, b: a + b, per_word).cast("long")


def lexicon_hits(text, words) -> Column:
    """Sum over words of non-overlapping, case-blind substring counts."""
    return _hits(F.lower(_col(text)), words)


def sentiment_score(positive, negative) -> Column:
    """(p - n) / (p + n), 0 when nothing was hit."""
    p, n = _col(positive), _col(negative)
    return F.coalesce(F.try_divide(p - n, p + n), F.lit(0.0))


def sentiment_category(score, threshold: float = 0.1) -> Column:
    score = _col(score)
    return (
        F.when(score > threshold, "positive")
        .when(score < -threshold, "negative")
        .otherwise("neutral")
    )


def paragraphs(text, sep: str = BLANK_LINE) -> Column:
    """Stripped, non-empty paragraphs in order."""
    parts = F.transform(F.split(_col(text), sep), strip)
    return F.filter(parts, lambda p: p != "")


def sampled_text(text, key, rate: float = 0.1, seed: int = 42, sep: str = BLANK_LINE) -> Column:
    """max(1, int(n * rate)) paragraphs in hash order, joined by a blank line.

    The draw depends on (seed, key, position) alone, so it repeats on any cluster
    layout; one text is one row, so nothing is shuffled.  No paragraph: the text.
    """
    text = _col(text)
    stem = F.concat(F.lit(f"{seed}:"), _col(key).cast("string"), F.lit(":"))

    def draw(parts):
        want = F.floor(F.size(parts).cast("double") * F.lit(float(rate))).cast("int")
        drawn = F.transform(
            parts,
            lambda p, i: F.struct(
                F.md5(F.concat(stem, i.cast("string"))).alias("h"),
                i.alias("i"),
                p.alias("p"),
            ),
        )
        picked = F.slice(F.array_sort(drawn), F.lit(1), F.greatest(F.lit(1), want))
        joined = F.array_join(F.transform(picked, lambda x: x["p"]), "\n\n")
        return F.when(F.size(parts) == 0, text).otherwise(joined)

    return let(paragraphs(text, sep), draw)


def words_of(text) -> Column:
    """Words between runs of white space."""
    body = strip(text)
    return F.when(body == "", F.array().cast("array<string>")).otherwise(
        F.split(body, f"{SPACE}+")
    )


def chunk_bounds(costs: np.ndarray, max_cost: int) -> list[int]:
    """Where chunks of words begin, and the end of the last one.

    The words of a chunk cost at most max_cost together, or are one word, so the next
    chunk is a jump in the running costs.  A first word that is already too dear leaves
    an empty chunk before it."""
    sums = np.append(0, np.cumsum(costs))
    bounds = [0, 0] if len(costs) and costs[0] > max_cost else [0]
    while bounds[-1] < len(costs):
        at = bounds[-1]
        bounds.append(max(at + 1, int(np.searchsorted(sums, sums[at] + max_cost, side="right")) - 1))
    return bounds


def chunked(text: str, max_cost: int) -> list[str]:
    """Greedy packing of the words of a text into chunks; a word costs len // 4 + 1."""
    words = text.split()
    if not words:
        return []
    costs = np.fromiter(map(len, words), np.int64, len(words)) // 4 + 1
    bounds = chunk_bounds(costs, max_cost)
    return [" ".join(words[a:b]) for a, b in zip(bounds, bounds[1:])]


def windows(chunk: str, cut: int) -> list[str]:
    """Consecutive windows of at most `cut` characters, without the blank ones."""
    found = (chunk[i : i + cut] for i in range(0, len(chunk), cut))
    return [p for p in found if p.strip()]


def slices_of(texts: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """texts in order, in slices of about `most` bytes, one text at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


def _per_text(cut_up: Callable[[str], list[str]], text) -> Column:
    """cut_up of every text, in Arrow batches; a missing text has no list.

    Strings are made of about SLICE bytes of texts at a time, however many a batch holds."""

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for few in slices_of(texts):
                cut = [None if t is None else cut_up(t) for t in few.to_pylist()]
                yield pa.array(cut, pa.list_(pa.string()))

    return run(_col(text))


def chunk_words(text, max_cost: int = 1000) -> Column:
    """Greedy packing of words into chunks of cost at most `max_cost`.

    A word costs len // 4 + 1; a first word that is already too dear leaves an empty
    chunk before it.
    """
    return _per_text(lambda t: chunked(t, max_cost), text)


def pieces(text, cut: int = 512) -> Column:
    """What a scorer sees: the chunks of the text in consecutive windows of at most `cut` characters.

    Every word of the text is in some piece, whatever its length; blank pieces are
    skipped, and a text without words has none.
    """
    return _per_text(lambda t: [w for c in chunked(t, 1000) for w in windows(c, cut)], text)


def signed_score(label, score) -> Column:
    """Scorer label and confidence -> (score, sentiment)."""
    label, score = _col(label), _col(score)
    up, down = label.isin(*POSITIVE_LABELS), label.isin(*NEGATIVE_LABELS)
    return F.struct(
        F.when(up, score).when(down, -score).otherwise(F.lit(0.0)).alias("score"),
        F.when(up, "positive").when(down, "negative").otherwise("neutral").alias("sentiment"),
    )


def lexicon_label(piece, positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS) -> Column:
    """A scorer that needs no weights: lexicon tone as (label, confidence)."""

    def label(score):
        return F.struct(
            sentiment_category(score).alias("label"), F.abs(score).alias("score")
        )

    return let(
        let(
            F.lower(_col(piece)),
            lambda low: sentiment_score(_hits(low, positive), _hits(low, negative)),
        ),
        label,
    )


def pooled_score(scored) -> Column:
    """Array of (score, sentiment) -> their mean and most common class.

    Equal counts go to the class seen first; an empty array is (0, neutral).
    """

    def ranked(kinds):
        return F.transform(
            F.array_distinct(kinds),
            lambda k: F.struct(
                F.size(F.filter(kinds, lambda x: x == k)).alias("n"),
                (-F.array_position(kinds, k)).alias("first"),
                k.alias("sentiment"),
            ),
        )

    def pool(items):
        total = F.aggregate(items, F.lit(0.0), lambda a, x: a + x["score"])
        top = F.array_max(let(F.transform(items, lambda x: x["sentiment"]), ranked))
        return F.struct(
            F.coalesce(F.try_divide(total, F.size(items)), F.lit(0.0)).alias("score"),
            F.coalesce(top["sentiment"], F.lit("neutral")).alias("sentiment"),
        )

    return let(_col(scored), pool)
