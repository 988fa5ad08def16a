"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A letter n-gram's vector binds (multiplies) its letters' vectors,
each permuted (rolled) by its place; a text's vector bundles (adds) those of its n-grams, a language's prototype
those of its texts. A text gets the language whose prototype is nearest by cosine.

All sums are of integers, so that neither the order of rows nor the partitions change a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix64, pick

DIM, SEED = 1024, 7
N = 3  # letters in an n-gram
UNKNOWN = "und"
_BITS, _ROWS = 18, 128  # of a letter's number, with room for all letters of Unicode; texts worked on at once


def _alphabet() -> np.ndarray:
    """Each code point's number among letters, from 1; 0 for what isn't a letter."""
    yes = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(yes, np.cumsum(yes), 0).astype(np.int64)


class Encoder:
    """Texts to counts of n-grams, and these to bundles; one per task."""

    number: np.ndarray | None = None
    code: np.ndarray

    def __init__(self, dim: int = DIM, seed: int = SEED):
        if Encoder.number is None:
            Encoder.number = _alphabet()
            Encoder.code = np.flatnonzero(np.concatenate([[1], Encoder.number]))  # letter k's code point, plus 1
        self.dim, self.seed = dim, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((4096, dim), np.int8)

    def letter(self, k: int) -> np.ndarray:
        """A letter's vector depends on its code point and the seed alone; 0 is the edge of a word."""
        if (v := self.letters.get(k)) is None:
            code = int(self.code[k]) if k else 0
            bits = mix64(np.arange(self.dim // 64, dtype=np.uint64) + np.uint64((code * 1_000_003 + self.seed) * 4096))
            v = self.letters[k] = np.unpackbits(bits.view(np.uint8)).astype(np.int8) * 2 - 1
        return v

    def matrix(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of these n-grams. Those made are kept, up to a number; then they are made anew."""
        if len(self.rows) + len(keys) > 60_000:
            self.rows.clear()
        out = []
        for key in keys.tolist():
            if (r := self.rows.get(key)) is None:
                r = self.rows[key] = len(self.rows)
                if r >= len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
                v = self.letter(key & (1 << _BITS) - 1)
                for i in range(1, N):
                    v = v * np.roll(self.letter(key >> _BITS * i & (1 << _BITS) - 1), i)
                self.vectors[r] = v
            out.append(r)
        return self.vectors[out].astype(np.float32)

    def counts(self, texts: list[str | None], group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, n-gram, how often) over words with their edges; texts of one group count together."""
        joined = "\n".join((t or "").lower() for t in texts)
        a = self.number[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        of = np.repeat(group, [len((t or "").lower()) + 1 for t in texts])
        a = np.concatenate([[0], a, [0]])
        keep = (a != 0) | (np.roll(a, 1) != 0)  # of a run of other characters, one
        keep[0] = True
        a, of = a[keep], np.concatenate([of[:1], of])[keep[: len(of) + 1]]
        if len(a) < N:
            return (np.empty(0, np.int64),) * 3
        key = sum(a[i : len(a) - N + 1 + i] << _BITS * i for i in range(N)) | of[1 : len(a) - N + 2] << _BITS * N
        key = key[(a[1 : len(a) - N + 2] != 0)]  # those with a letter in the middle
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        return key[first] >> _BITS * N, key[first] & (1 << _BITS * N) - 1, np.diff(np.concatenate([first, [len(key)]]))

    def bundles(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text; exact, as no sum nears 2**53 (or, in single precision, 2**24)."""
        of, key, n = self.counts(texts, np.arange(len(texts)))
        out = np.zeros((len(texts), self.dim))
        keys, place = np.unique(key, return_inverse=True)
        for i in range(0, len(keys), 8192):
            c = np.zeros((len(texts), min(8192, len(keys) - i)), np.float32)
            here = (place >= i) & (place < i + 8192)
            c[of[here], place[here] - i] = n[here]
            exact = np.float32 if c.sum(1).max(initial=0) < 1 << 24 else np.float64
            out += c.astype(exact) @ self.matrix(keys[i : i + 8192]).astype(exact)
        return out


def learn(texts: DataFrame, text: str = "text", lang: str = "lang", dim: int = DIM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototypes by language, over all rows whose text and language aren't null.

    Each task counts its own n-grams and bundles them once; what is shuffled and then collected is one row of
    ``dim`` integers for each language and task, and for each language. Empty input gives no prototypes.
    """

    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, names, total = Encoder(dim, seed), {}, {}
        for b in it:
            for c in chunks([b], _ROWS):
                langs = [names.setdefault(g, len(names)) for g in c.column(1).to_pylist()]
                local = {g: i for i, g in enumerate(dict.fromkeys(langs))}
                at = list(local)
                for g, key, n in zip(*(x.tolist() for x in enc.counts(c.column(0).to_pylist(), np.array([local[g] for g in langs]))), strict=True):
                    total[at[g], key] = total.get((at[g], key), 0) + n
                if len(total) > 1_000_000:
                    yield _sums(enc, names, total)
                    total.clear()
        if total:
            yield _sums(enc, names, total)

    known = pick(texts, t=text, g=lang).where("t is not null and g is not null")
    part = known.mapInArrow(sums, "lang string, v array<bigint>")
    # one row for each language and place, whose sums Spark combines before it shuffles
    total = part.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    rows = total.groupBy("lang").agg(F.expr("transform(array_sort(collect_list(struct(i, x))), p -> p.x)").alias("v")).collect()
    return {r["lang"]: np.array(r["v"], np.float64) for r in sorted(rows, key=lambda r: r["lang"])}


def _sums(enc: Encoder, names: dict[str, int], total: dict[tuple[int, int], int]) -> pa.RecordBatch:
    by = {g: ([], []) for g in names.values()}
    for (g, key), n in total.items():
        by[g][0].append(key)
        by[g][1].append(n)
    out = []
    for g in names.values():
        v, (keys, n) = np.zeros(enc.dim), by[g]
        for i in range(0, len(keys), 8192):
            v += np.array(n[i : i + 8192], np.float64) @ enc.matrix(np.array(keys[i : i + 8192])).astype(np.float64)
        out.append(v.astype(np.int64).tolist())
    return pa.RecordBatch.from_pydict({"lang": list(names), "v": out}, pa.schema([("lang", pa.string()), ("v", pa.list_(pa.int64()))]))


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = DIM, seed: int = SEED) -> DataFrame:
    """``docs`` (id, text) with lang_pred and score; see ``identify``. Prototypes are as many as languages."""
    names = list(prototypes)
    unit = np.stack([prototypes[g] / max(1e-9, np.linalg.norm(prototypes[g])) for g in names]) if names else np.zeros((1, dim))
    kind = next(f.dataType.simpleString() for f in docs.schema.fields if f.name == "id")

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, label = Encoder(dim, seed), np.array([*names, UNKNOWN], object)
        for b in chunks(it, _ROWS):
            v = enc.bundles(b.column(1).to_pylist())
            norm = np.linalg.norm(v, axis=1)
            cos = (v @ unit.T) / np.maximum(norm, 1e-9)[:, None]
            best = np.where((norm > 0) & bool(names), cos.argmax(1), len(names))  # ties go to the first language by name
            score = np.where(best < len(names), cos.max(1).clip(0, 1).round(6), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(label[best], pa.string()), pa.array(score, pa.float64())], ["id", "lang_pred", "score"])

    return docs.select("id", "text").mapInArrow(go, f"id {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """One document in four takes no part in learning; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", dim: int = DIM, seed: int = SEED) -> DataFrame:
    """(id_col, held_out, lang_pred, score) for every row of ``docs``.

    The prototypes are learned from the rows that aren't held out and have a language and a text. A prediction uses
    the text alone. A null or empty text, one without letters, or a table without any known language, gives
    ``und`` and 0. Repeated rows give repeated results; extra columns take no part.
    """
    rows = pick(docs, id=id_col, text=text, lang=lang)
    prototypes = learn(rows.where(~held_out(F.col("id"))), "text", "lang", dim, seed)
    return predict(rows, prototypes, dim=dim, seed=seed).select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def known(docs: DataFrame, min_score: float, id_col: str = "doc_id", text: str = "text", lang: str = "lang", dim: int = DIM, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is identified with at least ``min_score``."""
    names = docs.columns
    flat = docs.toDF(*(f"_{i}" for i in range(len(names))))
    rows = pick(docs, id=id_col, text=text, lang=lang)
    prototypes = learn(rows.where(~held_out(F.col("id"))), "text", "lang", dim, seed)
    whole = flat.select(F.struct(*flat.columns).alias("id"), F.col(f"_{names.index(text)}").alias("text"))
    kept = predict(whole, prototypes, dim, seed).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select("id.*").toDF(*names)
