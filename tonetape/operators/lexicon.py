"""Words of any number of lexicons, counted in one pass over a text."""

from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words an automaton may hold: each task builds its own, about 1 kB a word.
MOST_WORDS = 100_000


def meets_itself(word: str) -> bool:
    """Can two occurrences of the word overlap (as in `anan`)?"""
    return any(word.startswith(word[i:]) for i in range(1, len(word)))


def counter(lexicons: Mapping[str, Sequence[str]]):
    """A function from a lower-case text to its counts, one per lexicon.

    A count sums, over the words, the occurrences that `str.count` finds: those of one
    word do not overlap each other, those of different words may.  A word listed twice
    counts twice.
    """
    words = sorted({w.lower() for listed in lexicons.values() for w in listed})
    if "" in words:
        raise ValueError("an empty word occurs everywhere")
    slot = {w: i for i, w in enumerate(words)}
    weight = np.zeros((len(words), len(lexicons)), np.int64)
    for j, listed in enumerate(lexicons.values()):
        np.add.at(weight[:, j], [slot[w.lower()] for w in listed], 1)
    if not words:
        return lambda text: np.zeros(len(lexicons), np.int64)
    machine = ahocorasick.Automaton()
    for word, i in slot.items():
        machine.add_word(word, (i, len(word) if meets_itself(word) else 0))
    machine.make_automaton()

    def counts(text: str) -> np.ndarray:
        hits, least_end = [], {}
        for end, (i, length) in machine.iter(text):
            if length:
                if end < least_end.get(i, 0):
                    continue
                least_end[i] = end + length
            hits.append(i)
        return np.bincount(np.array(hits, np.int64), minlength=len(words)) @ weight

    return counts


def lexicon_counts(text: Column | str, lexicons: Mapping[str, Sequence[str]]) -> Column:
    """A struct with the hits of each lexicon, case-blind; a missing text has none.

    The same counts as `lexicon_hits`, which goes over the text once a word: use that for
    a few words, this for many.  A text is read once whatever the words, in Arrow batches.
    """
    names = list(lexicons)
    if len({w for listed in lexicons.values() for w in listed}) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words")

    @F.pandas_udf(", ".join(f"`{n}` long" for n in names))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = counter(lexicons)
        for texts in batches:
            found = [counts("" if t is None else t) for t in texts]
            yield pd.DataFrame(np.array(found).reshape(-1, len(names)), columns=names)

    low = F.lower(F.col(text) if isinstance(text, str) else text)
    return F.when(low.isNotNull(), run(low))


def read_lexicons(table: DataFrame, lexicon: str = "lexicon", word: str = "word") -> dict[str, list]:
    """Lexicons of a table with one row per word; more than MOST_WORDS words are an error.

    Null and empty words are left out, words that are equal in lower case count once.
    """
    kept = table.select(F.col(lexicon).alias("l"), F.lower(F.col(word)).alias("w"))
    found = kept.where("l is not null and w <> ''").distinct().limit(MOST_WORDS + 1).collect()
    if len(found) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words")
    out: dict[str, list] = {}
    for name, w in sorted(map(tuple, found)):
        out.setdefault(name, []).append(w)
    return out
