"""Byte-pair encoding of whole texts with a tokenizer file, on numpy arrays.

A text is cut at its spaces.  The words of a batch that are not known yet are
normalised and cut into pre-tokens as the file says, and the distinct pre-tokens are
merged together: their symbols lie in one ragged array, and each step applies, in every
sequence at once, the sequence's pair of lowest rank.  Steps go on with the sequences
that changed, and look up only the pairs that did.

A sequence of n symbols may take n steps, so long ones go another way: places wait by
the rank of their pair, and a step applies the lowest rank that waits at all its places
and touches nothing else.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tonetape.llm.common import kept_by_worker

#: Words kept by one worker before it starts anew, and their ids: bounds on its memory.
KNOWN, KNOWN_IDS = 400_000, 8_000_000
#: Bytes of a pre-token from which on it is merged by places.
LONG = 64
#: Characters of one text that are cut into pre-tokens at a time.
CHUNK = 1 << 20
#: Characters of text that are looked up together.
BLOCK = 4 << 20

# The pattern of the tokenizer file, its letters and digits spelt
# out for lower-case text below U+0250, where the standard module is faster.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ɏ]+|[0-9²³¹¼-¾]|[^\s a-zªµºß-öø-ɏ0-9²³¹¼-¾]+"
#: Characters whose lower case, spacing or class the fast way does not settle.
OTHER = re.compile("[^\t\n\r -~¡-¬®-įıĲ-ɏ]")


class Encoder:
    """One tokenizer file of the kind: NFC, lower case, pattern, byte level, word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        cut = spec["pre_tokenizer"]["pretokenizers"]
        if (
            model["type"] != "BPE"
            or kinds != ["NFC", "Replace", "Lowercase"]
            or cut[0]["pattern"] != {"Regex": PATTERN}
            or cut[1]["type"] != "ByteLevel"
            or model["unk_token"] is not None
        ):
            raise ValueError(f"{path}: not a word-level BPE file of the known kind")
        self.library = Tokenizer.from_file(path)
        self.cut = re.compile(LATIN + "|\n").findall
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or "\n" in t["content"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that reach beyond their string, or hold a line feed")
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        letters = byte_letters()
        end = model["end_of_word_suffix"]
        if not end or any((m if isinstance(m, list) else m.split(" "))[0].endswith(end) for m in model["merges"]):
            raise ValueError(f"{path}: merges that reach beyond a pre-token")
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        self.size = len(vocab)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.made = made
        self.tables = pair_tables(left * self.size + right, len(made))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 12, np.int32)
        self.ends = np.zeros(1, np.int64)
        # Cutting at spaces leaves empty words at the ends of a part.
        self.add(["", *self.special], np.fromiter(self.special.values(), np.int64), np.append(0, np.ones(len(self.special), np.int64)))

    def add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.ends[-1])
        if used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:used], np.zeros(used + 2 * len(ids), np.int32)])
        self.ids[used : used + len(ids)] = ids
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.ends = np.append(self.ends, used + np.cumsum(sizes))

    def sequences(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts at a time: the entries of their words, one text after
        another, and the number of words of each text.  An entry e has the
        symbols ids[ends[e]:ends[e + 1]]."""
        parts: list[str | list[str]] = []
        sizes: list[int] = []  # parts of each text
        held = 0
        for text in texts:
            before = len(parts)
            for part in self.parts(text or ""):
                parts.append(part)
                held += len(part)
                if held > BLOCK:
                    # The text goes on in the next block: a size of -1 says so.
                    yield self.look_up(parts, [*sizes, len(parts) - before], True)
                    parts, sizes, before, held = [], [], 0, 0
            sizes.append(len(parts) - before)
        yield self.look_up(parts, sizes, False)

    def entries(self, words: list[str]) -> np.ndarray:
        """The entry of each word, -1 for those that are not known."""
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def look_up(self, parts: list[str | list[str]], sizes: list[int], goes_on: bool) -> tuple[np.ndarray, np.ndarray]:
        is_cut = np.fromiter((isinstance(p, list) for p in parts), bool, len(parts))
        spaced = pc.ascii_split_whitespace(pa.array([p for p in parts if isinstance(p, str)], pa.string()))
        cut = pa.array([p for p in parts if isinstance(p, list)], pa.list_(pa.string()))
        n = np.concatenate([pc.list_value_length(c).to_numpy(zero_copy_only=False) for c in (spaced, cut)]).astype(np.int64)
        found = pa.concat_arrays([spaced.flatten(), cut.flatten()]).dictionary_encode()
        # No word holds a line feed, and one string comes out of Arrow faster than many.
        listed = pa.ListArray.from_arrays([0, len(found.dictionary)], found.dictionary)
        words = pc.binary_join(listed, "\n")[0].as_py().split("\n") if len(found.dictionary) else []
        # Words are looked up once: those that are new get the next entries, in their order.
        entries = self.entries(words)
        new = np.flatnonzero(entries < 0)
        if len(new):
            if len(self.known) + len(new) > KNOWN or self.ends[-1] > KNOWN_IDS:
                self.forget()
                entries = self.entries(words)
                new = np.flatnonzero(entries < 0)
            entries[new] = len(self.known) + np.arange(len(new))
            unknown = [words[k] for k in new.tolist()]
            self.add(unknown, *self.symbols(unknown))
        entries = entries[found.indices.to_numpy()]
        if is_cut.any():
            order = np.empty(len(parts), np.int64)
            order[np.argsort(is_cut, kind="stable")] = np.arange(len(parts))
            entries, n = taken(entries, n, order), n[order]
        own = np.diff(np.append(0, np.cumsum(n))[np.append(0, np.cumsum(np.array(sizes, np.int64)))])
        return entries, np.append(own, -1) if goes_on else own

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in one array, and the number of each word's."""
        plain, odd = "\n".join(words), []
        if OTHER.search(plain):
            # What the library has cut stays whole; what the fast way cuts has none of these characters.
            is_odd = [OTHER.search(w) is not None for w in words]
            odd = [w for w, o in zip(words, is_odd) if o]
            plain = "\n".join(w for w, o in zip(words, is_odd) if not o)
        own = self.cut(plain.lower())
        # Numbered by Arrow, whose dictionary holds the distinct ones' bytes one after the other.
        found = pa.array([*own, *odd], pa.string()).dictionary_encode()
        pretokens, entries = found.dictionary, found.indices.to_numpy().astype(np.int64)
        feed = pc.index(pretokens, "\n").as_py()
        if feed >= 0:
            entries = np.where(entries == feed, -1, entries - (entries > feed))
            pretokens = pa.concat_arrays([pretokens[:feed], pretokens[feed + 1 :]])
        ids, length = self.merge(pretokens)
        entries, whole = entries[: len(own)], entries[len(own) :]
        gaps = np.flatnonzero(entries < 0)
        sizes = np.diff(np.concatenate([[-1], gaps, [len(own)]])) - 1 if own else np.zeros(0, np.int64)
        entries = np.append(entries[entries >= 0], whole)
        sizes = np.append(sizes, np.ones(len(odd), np.int64))
        if odd:
            place = np.argsort(np.array(is_odd), kind="stable")
            order = np.empty(len(words), np.int64)
            order[place] = np.arange(len(words))
            entries, sizes = taken(entries, sizes, order), sizes[order]
        return taken(ids, length, entries), np.add.reduceat(length[entries], starts_of(sizes))

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Number of ids of each text."""
        return self.run(texts, False)[1]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each text."""
        return self.run(texts, True)

    def run(self, texts: list[str | None], with_ids: bool) -> tuple[np.ndarray, np.ndarray]:
        totals, parts, goes_on = [], [np.zeros(0, np.int32)], False
        for entries, sizes in self.sequences(texts):
            lengths = self.ends[entries + 1] - self.ends[entries]
            if with_ids:
                stops = np.cumsum(lengths)
                total = int(stops[-1]) if len(stops) else 0
                parts.append(self.ids[np.arange(total) + np.repeat(self.ends[entries] - (stops - lengths), lengths)])
            open_end = len(sizes) > 0 and sizes[-1] == -1
            stops = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(sizes[:-1] if open_end else sizes))]
            own = np.diff(stops)
            if goes_on and len(own):
                totals[-1] += own[0]
                own = own[1:]
            totals.extend(own)
            goes_on = open_end
        return np.concatenate(parts), np.array(totals, np.int64)

    def parts(self, text: str) -> Iterator[str | list[str]]:
        """Parts of text to be cut at their spaces, lists of pre-tokens where the library must cut, and special strings."""
        for at, part in enumerate(self.split(text) if self.split else [text]):
            if at % 2:
                yield [part]
                continue
            start = 0
            while start < len(part):
                stop = len(part)
                if stop - start > CHUNK:
                    gap = re.compile("[ \n]").search(part, start + CHUNK)
                    stop = gap.end() if gap else stop
                chunk, start = (part if stop - start == len(part) else part[start:stop]), stop
                if not OTHER.search(chunk):
                    yield chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)
                else:
                    cut = self.library.pre_tokenizer.pre_tokenize_str
                    text_of = byte_text()
                    yield [text_of(w) for w, _ in cut(self.library.normalizer.normalize_str(chunk))]

    def merge(self, words: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all pre-tokens in one array, and the number of each one's."""
        raw = pa.array(words, pa.string()) if isinstance(words, list) else words
        bounds, held = raw.buffers()[1:]
        bounds = np.frombuffer(bounds, np.int32, len(raw) + 1, 4 * raw.offset).astype(np.int64) if bounds else np.zeros(1, np.int64)
        length = np.diff(bounds)
        flat = np.frombuffer(held or b"", np.uint8)[bounds[0] : bounds[-1]]
        ids = self.inner[flat]
        ends = np.cumsum(length)
        ids[ends - 1] = self.last[flat[ends - 1]]
        at = np.arange(len(raw))
        long = length >= LONG
        out = [np.zeros(0, np.int64)], [at[:0]], [at[:0]]
        if long.any():
            part = np.repeat(long, length)
            made = self.merge_places(ids[part], length[long])
            ids, length, at = ids[~part], length[~long], at[~long]
            for kept, new in zip(out, (*made, np.flatnonzero(long))):
                kept.append(new)
        rank = self.rank(ids)
        while len(at):
            starts = starts_of(length)
            done = np.minimum.reduceat(rank, starts) == len(self.made)
            if done.any():
                part = np.repeat(done, length)
                for kept, new in zip(out, (ids[part], length[done], at[done])):
                    kept.append(new)
                ids, rank, length, at = ids[~part], rank[~part], length[~done], at[~done]
            if len(at):
                ids, rank, length = self.step(ids, rank, length)
        ids, length, at = map(np.concatenate, out)
        order = np.argsort(at)
        return taken(ids, length, order), length[order]

    def rank(self, ids: np.ndarray, following: np.ndarray | None = None) -> np.ndarray:
        """Ranks of the pairs of ids and following (the next ones, if none are given); len(made) where there is no merge.
        The last symbol of a pre-token has none: nothing merges with what follows an end of word."""
        if following is None:
            following = np.append(ids[1:], ids[:0] if not len(ids) else -1)
        pair = np.where(following >= 0, ids * self.size + following, -2)
        out = None
        for factor, keys, ranks in self.tables:
            slot = slots(pair, factor, len(keys))
            own = np.where(keys[slot] == pair, ranks[slot], len(self.made))
            out = own if out is None else np.minimum(out, own)
        return out

    def step(self, ids: np.ndarray, rank: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One merge in every sequence; each has one."""
        starts = starts_of(length)
        hit = rank == np.repeat(np.minimum.reduceat(rank, starts), length)
        hit = odd_places(np.flatnonzero(hit), np.arange(1, len(ids) + 1))
        gone = np.zeros(len(ids), bool)
        gone[hit + 1] = True
        ids[hit] = self.made[rank[hit]]
        ids, rank = ids[~gone], rank[~gone]
        length = length - np.add.reduceat(gone.astype(np.int64), starts)
        hit = hit - np.arange(len(hit))
        changed = np.concatenate([hit[hit > 0] - 1, hit])
        rank[changed] = self.rank(ids[changed], np.append(ids, -1)[changed + 1])
        return ids, rank, length

    def merge_places(self, ids: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of long sequences in one array, and the number of each one's."""
        n, none = len(ids), len(self.made)
        after, before = np.arange(1, n + 1), np.arange(-1, n)
        ids = np.append(ids, -1)
        rank = np.append(self.rank(ids[:-1]), none)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] < none]
            places = places[np.argsort(rank[places], kind="stable")]
            own = rank[places]
            firsts = np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)]).tolist()
            for first, end in zip(firsts, [*firsts[1:], len(own)]):
                key = int(own[first])
                if key not in waiting:
                    heapq.heappush(heap, key)
                waiting.setdefault(key, []).append(places[first:end])

        wait(np.arange(n))
        while heap:
            least = heapq.heappop(heap)
            places = np.unique(np.concatenate(waiting.pop(least)))
            places = odd_places(places[rank[places] == least], after)
            gone = after[places]
            right = after[gone]
            ids[places], ids[gone], rank[gone] = self.made[least], -1, none
            after[places], before[right] = right, places
            left = before[places]
            changed = np.unique(np.concatenate([left[left >= 0], places]))
            rank[changed] = self.rank(ids[changed], ids[after[changed]])
            wait(changed)
        live = ids[:-1] >= 0
        return ids[:-1][live], np.add.reduceat(live.astype(np.int64), starts_of(length))


def slots(pair: np.ndarray, factor: int, size: int) -> np.ndarray:
    return ((pair.view(np.uint64) * np.uint64(factor)) >> np.uint64(65 - size.bit_length())).view(np.int64)


def pair_tables(pair: np.ndarray, none: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Tables (factor, keys, ranks) by a multiplied hash, one after the other until each pair has a slot of its own."""
    tables, left, factor = [], np.arange(len(pair)), 0x9E3779B97F4A7C15
    while len(left):
        size = 1 << (8 * len(left)).bit_length()
        keys, ranks = np.full(size, -1, np.int64), np.full(size, none, np.int64)
        slot, first = np.unique(slots(pair[left], factor, size), return_index=True)
        keys[slot], ranks[slot] = pair[left[first]], left[first]
        tables.append((factor, keys, ranks))
        left = np.delete(left, first)
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
    return tables


def starts_of(length: np.ndarray) -> np.ndarray:
    return np.cumsum(length) - length


def taken(ids: np.ndarray, length: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The sequences of entries, one after the other; ids holds all sequences."""
    own = length[entries]
    return ids[np.arange(own.sum()) + np.repeat(starts_of(length)[entries] - starts_of(own), own)]


def odd_places(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of ascending places of one pair, those that are merged: in a run that overlaps (aaa), the first, third, ..."""
    number = np.arange(len(places))
    first = np.append(True, after[places[:-1]] != places[1:])[: len(places)]
    return places[(number - np.maximum.accumulate(np.where(first, number, 0))) % 2 == 0]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    letters |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in letters)}
    return [letters[b] for b in range(256)]


@lru_cache
def byte_text():
    back = {c: b for b, c in enumerate(byte_letters())}
    return lambda word: bytes(back[c] for c in word).decode("utf-8")


@kept_by_worker
@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
