"""BPE encoding and decoding by batched merge rounds in numpy.

Reads a vocabulary file of the public tokenizers format whose model is BPE with an end-of-word suffix over
byte-level characters. The words of a batch of texts that are not known yet are laid out as one flat
array of symbols; each round finds every neighbouring pair in the sorted array of mergeable pair keys
by binary search, takes the lowest rank of each word and merges that pair wherever it stands in the word.
Every merge makes another token and no token can be part of a merge before it is made, so merging all
places of the lowest pair at once gives what merging one by one gives.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.llm.shared import bounded, free_name, slices, table

KNOWN_WORDS = 50_000
_NO_RANK = np.iinfo(np.int64).max


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where Latin-1 prints it, else the next from 256 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


def _of_category(kind: str) -> str:
    """Ranges of a character class: the code points whose general category starts with ``kind``."""
    inside = np.array([unicodedata.category(chr(c))[0] == kind for c in range(0x110000)])
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist())


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = np.full(max(*vocab.values(), *special.values()) + 1, "", object)
        for token, i in (vocab | special).items():
            self.tokens[i] = token
        self.special = special
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        steps = file["pre_tokenizer"]["pretokenizers"]
        pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.word, self.wide_pattern, self.wide = regex.compile(pattern), pattern, None
        self.inside = np.array([vocab[c] for c in byte_characters()], np.int64)
        self.final = np.array([vocab[c + suffix] for c in byte_characters()], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.base = len(self.tokens)
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        by = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[by], by, made[by]
        self.known: dict[str, list[int]] = {}

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return self.word.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._wide_word().findall(text)
        return self.word.findall(text)

    def _wide_word(self):
        """The same pattern with letters and numbers as Unicode 15 has them: what came later is neither in the
        tokenizers library."""
        if self.wide is None:
            pattern = self.wide_pattern
            for kind in "LN":
                members = _of_category(kind)
                pattern = pattern.replace(f"[\\p{{{kind}}}]", f"[{members}]").replace(f"\\p{{{kind}}}", members)
            self.wide = regex.compile(pattern)
        return self.wide

    def parts(self, text: str) -> list[str]:
        """The text's words; special tokens stand among them as they are."""
        if self.specials is None or "<|" not in text:
            return self.words(text)
        pieces = self.specials.split(text)
        return [w for i, p in enumerate(pieces) for w in ([p] if i % 2 else self.words(p))]

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of words that are not empty."""
        encoded = [w.encode() for w in words]
        length = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.frombuffer(b"".join(encoded), np.uint8)
        word = np.repeat(np.arange(len(words)), length)
        symbols = self.inside[flat]
        ends = np.cumsum(length) - 1
        symbols[ends] = self.final[flat[ends]]
        done: list[list[int]] = [[]] * len(words)

        def put(word, symbols):
            if len(word):
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                ids, ends = symbols.tolist(), [*first[1:].tolist(), len(symbols)]
                for w, a, b in zip(word[first].tolist(), first.tolist(), ends):
                    done[w] = ids[a:b]

        while len(symbols):
            pair = symbols[:-1] * self.base + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            found = (self.keys[at] == pair) & (word[:-1] == word[1:])
            rank = np.append(np.where(found, self.ranks[at], _NO_RANK), _NO_RANK)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(word)))
            low = np.repeat(lowest, count)
            going = low < _NO_RANK
            put(word[~going], symbols[~going])
            here = (rank == low) & going
            # of overlapping places (a pair of twice the same symbol) every second one, from the left
            spot = np.flatnonzero(here)
            fresh = np.r_[True, np.diff(spot) > 1]
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(spot)), 0))
            spot = spot[(np.arange(len(spot)) - run) % 2 == 0]
            symbols[spot] = self.made[at[spot]]
            keep = going.copy()
            keep[spot + 1] = False
            symbols, word = symbols[keep], word[keep]
        return done

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.parts(t) for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        new = [w for w in dict.fromkeys(chain.from_iterable(parts)) if w not in self.known]
        for at in range(0, len(new), 1 << 15):
            some = new[at : at + (1 << 15)]
            self.known.update(zip(some, self.merge(some)))
        self.known.update({t: [i] for t, i in self.special.items()})
        ids_of = self.known.__getitem__
        return [np.fromiter(chain.from_iterable(map(ids_of, p)), np.int32) for p in parts]

    def decode(self, ids: np.ndarray) -> str:
        """The file names no decoder: tokens joined by one space; ids without a token are left out."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.base):
            ids = ids[(ids >= 0) & (ids < self.base)]
        return " ".join(self.tokens[ids].tolist())


def encode(text: Column, path: str | None = None) -> Column:
    """Token ids of whole texts; null and empty texts, and texts without a word, give an empty array."""
    path = path or default_path()

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = Bpe(path)
        for texts in slices(batches):
            yield pd.Series(bpe.encode([t or "" for t in texts]), dtype=object)

    return of_batches(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """Texts of id arrays, special tokens included; a null array gives the empty text."""
    path = path or default_path()

    @F.pandas_udf(T.StringType())
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = Bpe(path)
        for arrays in slices(batches):
            yield pd.Series(["" if a is None else bpe.decode(a) for a in arrays], dtype=object)

    return of_batches(ids)


def round_trip(text: Column, path: str | None = None) -> Column:
    """Struct of ids, as by ``encode``, and decoded, as by ``decode`` of these ids, in one pass over the texts."""
    path = path or default_path()

    @F.pandas_udf("ids array<int>, decoded string")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = Bpe(path)
        for texts in slices(batches):
            ids = bpe.encode([t or "" for t in texts])
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series([bpe.decode(i) for i in ids], dtype=object)})

    return of_batches(text)


def encoded(docs, path: str | None = None):
    """``docs`` with the columns ``ids`` and ``decoded``, which replace columns of these names.

    Every row gives one row, repeated ones too; null and empty texts have no ids and decode to the empty text.
    """
    docs = bounded(docs)
    both = free_name(docs, "coded")
    coded = docs.withColumn(both, round_trip(F.col("text"), path))
    return coded.withColumns({n: F.col(both)[n] for n in ("ids", "decoded")}).drop(both)


def digests(docs, path: str | None = None):
    return encoded(docs.select("doc_id", "text"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op8_bpe_codec(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
