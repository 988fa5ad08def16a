"""Quality rules as a short-circuit cascade.

Each rule's cost and selectivity are estimated on a bounded sample; the rules then run in the order of rejections per
cost, and a text that one rejects meets no further rule. The order changes the work, never the verdict: a text is
kept if no rule rejects it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix64, pick

SAMPLE_ROWS = 2000  # about so many rows the estimates are made on
_SYMBOLS = str.maketrans("", "", "#*$%&|<>")


class Text:
    """A text and what rules share of it, each made once and only when asked for.

    ``cost`` counts the characters and words that were worked on: a measure of cost that does not change from run to run.
    """

    def __init__(self, text: str | None):
        self.text, self.cost = text or "", 0

    @cached_property
    def words(self) -> list[bytes]:
        self.cost += len(self.text) // 8
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def word_chars(self) -> int:
        joined = b"".join(self.words)
        self.cost += len(joined) // 16
        return len(joined.decode("utf-8", "surrogatepass"))

    @cached_property
    def n_symbols(self) -> int:
        self.cost += len(self.text) // 4
        return len(self.text) - len(self.text.translate(_SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        self.cost += len(self.text) // 16
        return [x for x in self.text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]

    @cached_property
    def n_dup_lines(self) -> int:
        self.cost += 2 * len(self.lines)
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        self.cost += 6 * len(self.words)
        return repeat_words(self.words)

    @cached_property
    def n_upper(self) -> int:
        self.cost += len(self.text)
        return sum(map(str.isupper, self.text))

    @cached_property
    def n_alpha_words(self) -> int:
        self.cost += 2 * len(self.text)
        return sum(1 for w in re.findall(r"[^\x20\x09-\x0D]+", self.text) if any(map(str.isalpha, w)))


def repeat_words(words: list[bytes], n: int = 3) -> int:
    """Words in windows of ``n`` words that occur twice or more, first included; each word counts once."""
    if len(words) <= n:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    with np.errstate(over="ignore"):
        w = sum(mix64(h[i : len(h) - n + 1 + i] + np.uint64(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(2 * i + 3) for i in range(n))
    order = np.argsort(w, kind="stable")
    same = w[order][1:] == w[order][:-1]
    twice = np.zeros(len(w), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for i in range(n):
        covered[i : len(words) - n + 1 + i] |= twice
    return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


#: Bounds chosen so that ordinary prose of any topic passes; each compares exact integers.
RULES = (
    Rule("short", lambda t: len(t.words) < 50),
    Rule("repeated", lambda t: 100 * t.n_repeat_words > 50 * len(t.words)),
    Rule("word_length", lambda t: not 2 * len(t.words) <= t.word_chars <= 15 * len(t.words)),
    Rule("symbols", lambda t: 100 * t.n_symbols > 25 * len(t.words)),
    Rule("dup_lines", lambda t: 100 * t.n_dup_lines > 50 * max(1, len(t.lines))),
    Rule("shouting", lambda t: 100 * t.n_upper > 60 * t.word_chars),
    Rule("no_letters", lambda t: 100 * t.n_alpha_words < 60 * len(t.words)),
)
#: The rules of the base verdict; these must be among the rules of a cascade that is compared with it.
BASE = ("short", "repeated")


def plan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, mean cost, share rejected) in the order to run them, from about ``sample_rows`` rows spread over the table.

    Costs are of each rule by itself on a fresh text. Rules that reject nothing come last, cheapest first; ties go by name.
    """
    rows = pick(docs, id=id_col, text=text)
    # a hash picks the sample: the same rows on each run, whatever the partitions, and each is measured where it is read
    share = min(1.0, sample_rows / max(1, rows.count()))
    sample = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, rejected, n = Counter(), Counter(), 0
        for b in it:
            for x in b.column(1).to_pylist():
                n += 1
                for r in rules:
                    t = Text(x)
                    rejected[r.name] += r.rejects(t)
                    cost[r.name] += t.cost + 1
        yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "cost": [cost[r.name] for r in rules], "rejected": [rejected[r.name] for r in rules], "n": [n] * len(rules)}, pa.schema([("rule", pa.string()), ("cost", pa.int64()), ("rejected", pa.int64()), ("n", pa.int64())]))

    got = sample.mapInArrow(measure, "rule string, cost long, rejected long, n long").groupBy("rule").agg(*(F.sum(c).alias(c) for c in ("cost", "rejected", "n"))).collect()
    rated = {r["rule"]: (r["cost"] / max(1, r["n"]), r["rejected"] / max(1, r["n"])) for r in got}
    order = sorted((r.name for r in rules), key=lambda k: (-(rated.get(k, (1, 0))[1] / max(1e-9, rated.get(k, (1, 0))[0])), rated.get(k, (1, 0))[0], k))
    return [(k, *rated.get(k, (1.0, 0.0))) for k in order]


def assess(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """For every row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by, n_rules_run.

    ``kept`` is false if the base verdict fails or a rule rejects the text. ``rejected_by`` is the first rule, in the
    planned order, that does. A null or empty text has no words and is not kept. Repeated rows give repeated results;
    extra columns take no part; an empty table gives no rows.
    """
    rows = pick(docs, id=id_col, text=text)
    by = {r.name: r for r in rules}
    order = [by[k] for k, *_ in plan(rows, "id", "text", rules, sample_rows)]
    kind = next(f.dataType.simpleString() for f in rows.schema.fields if f.name == "id")
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, 1000):
            out = {k: [] for k in (*fields, "base_failed", "kept", "rejected_by", "n_rules_run")}
            for x in b.column(1).to_pylist():
                t, ran, by_rule = Text(x), 0, None
                for r in order:
                    ran += 1
                    if r.rejects(t):
                        by_rule = r.name
                        break
                for k in fields[1:]:
                    out[k].append(getattr(t, k))
                n = len(t.words)
                out["n_words"].append(n)
                failed = n < 50 or 100 * t.n_repeat_words > 50 * n
                out["base_failed"].append(failed)
                out["kept"].append(not failed and by_rule is None)
                out["rejected_by"].append(by_rule)
                out["n_rules_run"].append(ran)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(out[k], pa.int64()) for k in fields), pa.array(out["base_failed"], pa.bool_()), pa.array(out["kept"], pa.bool_()), pa.array(out["rejected_by"], pa.string()), pa.array(out["n_rules_run"], pa.int64())], ["id", *out])

    schema = f"id {kind}, " + ", ".join(f"{k} long" for k in fields) + ", base_failed boolean, kept boolean, rejected_by string, n_rules_run long"
    return rows.mapInArrow(go, schema).withColumnRenamed("id", id_col)
