"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score. DataFrame functions only.

Offsets count code points, the end is exclusive. Patterns are written so that no start inside a run is tried again
and no repetition recurses: they take linear time and constant stack on texts of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
# How long an account number is, by its country.
IBAN = {
    15: ["NO"], 16: ["BE"], 18: ["DK", "FI", "FO", "GL", "NL", "SD"], 19: ["MK", "SI"], 20: ["AT", "BA", "EE", "KZ", "LT", "LU", "XK"], 21: ["CH", "HR", "LI", "LV"],
    22: ["BG", "BH", "CR", "DE", "GB", "GE", "IE", "ME", "RS", "VA"], 23: ["AE", "GI", "IL", "IQ", "TL"], 24: ["AD", "CZ", "ES", "MD", "PK", "RO", "SA", "SE", "SK", "TN", "VG"],
    25: ["LY", "PT", "ST"], 26: ["IS", "TR"], 27: ["FR", "GR", "IT", "MC", "MR", "SM"], 28: ["AL", "AZ", "BY", "CY", "DO", "GT", "HU", "LB", "PL", "SV"], 29: ["BR", "EG", "PS", "QA", "UA"],
    30: ["JO", "KW", "MU"], 31: ["MT", "SC"], 32: ["LC"], 33: ["RU"],
}
#: Patterns by kind. A possessive repetition takes the same run as a greedy one here, as nothing after it could use what it would give back.
#: A start within a run would end as the run's own start does; ``\G`` admits one right after the previous match.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": "(?=[A-Z]{2}[0-9]{2})(?<![A-Za-z0-9])(?:" + "|".join(rf"(?:{'|'.join(c)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in sorted(IBAN.items())) + ")(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "dni": r"(?<![A-Za-z0-9])[XYZ0-9][0-9]{7}-?[A-Z](?![A-Za-z0-9])",
    "nir": r"(?<![A-Za-z0-9])[12]\x20?[0-9]{2}\x20?[0-9]{2}\x20?[0-9][0-9AB]\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{2}(?![A-Za-z0-9])",
    "steuerid": r"(?<![A-Za-z0-9.,-])[1-9][0-9]\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{3}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,80}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{32})(?![A-Za-z0-9_])",
}
#: What a text must have for a kind to be looked for at all: a text, or a pattern that is quickly seen to fail.
_NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
_SIGNS = {"dni": "[0-9]{7}-?[A-Z]", "nir": r"[0-9]{2}\x20?[0-9][0-9AB]\x20?[0-9]{3}\x20?[0-9]{3}", "steuerid": r"[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{3}", "secret": "AKIA[0-9A-Z]|gh[pousr]_|xox[abprs]-|[0-9A-Fa-f]{32}"}
BASE = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)

# A kind's score before its context is seen, and the words that raise it within WINDOW code points before or
# after a span (those that lower it: before). A kind that isn't of BASE is kept from KEEP: a checksum alone is enough for iban, dni and nir unless the
# context speaks against it; ssn, steuerid and secret need words that speak for them.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.65, "ssn": 0.4, "dni": 0.55, "nir": 0.65, "steuerid": 0.35, "secret": 0.35}
CONTEXT = {
    "email": "mail|contact|write to|reach",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|master|amex|credit|debit|pay",
    "phone": "phone|tel|call|mobile|fax|contact",
    "iban": "iban|account|bank|transfer|konto|compte|cuenta",
    "ssn": "ssn|social security|tax id",
    "dni": "dni|nie|nif|documento|identidad|passport|id card",
    "nir": "nir|sécu|insee|social",
    "steuerid": "steuer|tax id|tin|idnr",
    "secret": "token|secret|key|password|passwd|pwd|credential|bearer|auth",
}
AGAINST = "version|order|invoice|isbn|ticket|serial|commit|checksum"
WINDOW, RAISE, LOWER, KEEP = 40, 0.3, 0.25, 0.5
#: So many pieces of a text, gaps and matches in turn, always have WINDOW code points: each match has five or more.
_PIECES = 2 * (WINDOW // 5)
#: A number's letter by its remainder by 23.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's checksum."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number, without blanks, leaves 1 by 97 (letters count 10 to 35)."""
    turned = F.concat(F.substring(iban, 5, 40), F.substring(iban, 1, 4))
    value = lambda ch: F.when(ch.between("0", "9"), F.ascii(ch) - 48).otherwise(F.ascii(ch) - 55)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, ch: F.when(ch.between("0", "9"), a * 10 + value(ch)).otherwise(a * 100 + value(ch)) % 97) == 1


def dni_letter(m: Column) -> Column:
    """Whether a Spanish identity number, without hyphen, ends in its letter (X, Y and Z stand for 0, 1 and 2)."""
    n = F.translate(F.substring(m, 1, 8), "XYZ", "012").cast("int")
    return F.substr(F.lit(DNI_LETTERS), n % 23 + 1, F.lit(1)) == F.right(m, F.lit(1))


def nir_key(m: Column) -> Column:
    """Whether a French social security number, without blanks, ends in its key, 97 less its remainder by 97 (2A and 2B count 19 and 18)."""
    n = F.regexp_replace(F.regexp_replace(F.substring(m, 1, 13), "A", "0"), "B", "0").try_cast("long")
    less = F.when(F.contains(m, F.lit("A")), 1_000_000).when(F.contains(m, F.lit("B")), 2_000_000).otherwise(0)
    return 97 - (n - less) % 97 == F.right(m, F.lit(2)).cast("int")


def iso7064(m: Column) -> Column:
    """Whether eleven digits end in their check digit (modulus 11, 10)."""
    p = F.aggregate(F.split(F.substring(m, 1, 10), ""), F.lit(10), lambda a, d: F.when((a + d.cast("int")) % 10 == 0, 10).otherwise((a + d.cast("int")) % 10) * 2 % 11)
    return (11 - p) % 10 == F.right(m, F.lit(1)).cast("int")


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")).between(1, 3) & (F.right(F.concat(F.lit("00"), F.regexp_replace(p, "^0+(?=.)", "")), F.lit(3)) <= "255"))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(m, " ", ""))
    if kind == "ssn":
        return ~m.rlike("^(000|666|9)|-00-|-0000$")
    if kind == "dni":
        return dni_letter(F.regexp_replace(m, "-", ""))
    if kind == "nir":
        return nir_key(F.regexp_replace(m, " ", ""))
    if kind == "steuerid":
        return iso7064(_digits(m))
    return F.lit(True)


def _named(x: Column, f) -> Column:
    """``f`` of ``x``, which is evaluated once however often ``f`` uses it."""
    return F.transform(F.array(x), f)[0]


def _in_parts(xs: Column, start: Column, step, state: str) -> Column:
    """``xs`` folded as by ``aggregate``, whose state's array ``out`` grows by an element for each, in parts of about the
    root of their number: an array that grows is copied each time, so one fold would take the square of their number."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs)))).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(xs) / width).cast("int") - 1, F.lit(0))), lambda i: F.slice(xs, i * width + 1, width))
    none = F.expr(f"cast(array() as array<{state}>)")
    nested = F.expr(f"cast(array() as array<array<{state}>>)")

    def part(a: Column, xs: Column) -> Column:
        done = F.aggregate(xs, F.struct(a["at"].alias("at"), none.alias("out")), step)
        return _named(done, lambda d: F.struct(d["at"].alias("at"), F.concat(a["out"], F.array(d["out"])).alias("out")))

    return F.aggregate(parts, F.struct(start.alias("at"), nested.alias("out")), part, lambda a: F.flatten(a["out"]))


def spans(text: Column, kind: str) -> Column:
    """The kind's spans that pass its validator: array of (kind, start, end, match, score).

    A text is split at the matches; the pieces' lengths and the matches' give the places. Python, and a second
    search for each match, aren't needed. The context is what the pieces have within WINDOW of the span, on both sides;
    words that speak against a kind label what follows, and count before the span only.
    """
    p = F.lit(PATTERNS[kind])
    zipped = F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("m"))
    short = lambda s: F.when(F.length(s) > 2 * WINDOW, F.concat(F.left(s, F.lit(WINDOW)), F.right(s, F.lit(WINDOW)))).otherwise(F.coalesce(s, F.lit("")))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m")))).alias("out"))

    def scored(z: Column) -> Column:
        def around(places: Column, pieces: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                first = F.greatest(2 * i + 1 - _PIECES, F.lit(0))  # of match i: pieces 0 to 2i are before, from 2i + 2 on after
                before = F.right(F.array_join(F.slice(pieces, first + 1, 2 * i + 1 - first), ""), F.lit(WINDOW))
                after = F.left(F.array_join(F.slice(pieces, 2 * i + 3, F.lit(_PIECES)), ""), F.lit(WINDOW))
                near = F.lower(F.concat(before, F.lit(" "), after))
                score = F.lit(PRIOR[kind]) + F.when(near.rlike(rf"\b(?:{CONTEXT[kind]})"), RAISE).otherwise(0.0) - F.when(F.lower(before).rlike(rf"\b(?:{AGAINST})\b"), LOWER).otherwise(0.0)
                valid = F.when(x["m"].isNull(), False).otherwise(_valid(kind, x["m"]))
                return F.when(valid, F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["m"].alias("match"), F.round(score, 2).alias("score")))

            return F.filter(F.transform(places, one), lambda x: x.isNotNull() & (x["score"] >= (KEEP if kind not in BASE else 0.0)))

        places = _in_parts(z, F.lit(0), step, "struct<start:int,end:int,m:string>")
        pieces = F.flatten(F.transform(z, lambda x: F.array(short(x["gap"]), short(x["m"]))))
        return _named(F.struct(places.alias("at"), pieces.alias("p")), lambda b: around(b["at"], b["p"]))

    made = _named(zipped, scored)
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,match:string,score:double>>)")
    has = text.rlike(PATTERNS[kind])  # most texts have no match: one search, and no array, for these
    if kind in _NEEDS:
        has = F.contains(text, F.lit(_NEEDS[kind])) & has
    if kind in _SIGNS:
        has = text.rlike(_SIGNS[kind]) & has
    return F.when(has, made).otherwise(none)


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, text, findings) for every row; ``findings``: array of (kind, start, end, match, score), by kind as in KINDS, then start.

    Kinds of BASE are kept whatever their score; others from a score of KEEP. A null text counts as empty and has none.
    Repeated rows give repeated results; extra columns take no part; an empty table gives no rows.
    """
    rows = pick(docs, id=id_col, text=text).withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    # most texts have no digit, which all kinds but the first and the last need
    t, none = F.col("text"), F.expr("cast(array() as array<struct<kind:string,start:int,end:int,match:string,score:double>>)")
    found = F.concat(spans(t, KINDS[0]), F.when(t.rlike("[0-9]"), F.concat(*(spans(t, k) for k in KINDS[1:-1]))).otherwise(none), spans(t, KINDS[-1]))
    return rows.select(F.col("id").alias(id_col), "text", found.alias("findings"))


def _joined(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and places for each row; the texts themselves are not returned."""
    f = F.col("findings")
    count = lambda k: F.size(F.filter(f, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return find(docs, id_col, text).select(
        id_col,
        *(count(k) for k in BASE),
        F.sha2(_joined(F.filter(f, lambda x: x["kind"].isin(*BASE))), 256).alias("base_sha256"),
        _joined(f).alias("spans"),
        F.array_join(F.transform(f, lambda x: x["score"].cast("string")), ",").alias("scores"),
    )


def redact(text: Column, findings: Column) -> Column:
    """The text with each finding replaced by its kind in brackets; what overlaps an earlier one is joined to it.

    What is kept is taken from the text in pieces between findings, in parts of about the root of their number, so that
    neither the text nor what is done is gone through anew for each.
    """
    ordered = F.array_sort(F.transform(findings, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def step(a: Column, x: Column) -> Column:
        piece = F.struct(F.when(x["start"] < a["at"], -1).otherwise(a["at"]).alias("begin"), x["start"].alias("stop"), F.upper(x["kind"]).alias("kind"))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.concat(a["out"], F.array(piece)).alias("out"))

    def made(xs: Column) -> Column:
        pieces = F.filter(_in_parts(xs, F.lit(0), step, "struct<begin:int,stop:int,kind:string>"), lambda x: x["begin"] >= 0)
        last = F.aggregate(xs, F.lit(0), lambda a, x: F.greatest(a, x["end"]))

        def joined(ps: Column) -> Column:
            width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(ps)))).cast("int")

            def part(i: Column) -> Column:
                mine = F.slice(ps, i * width + 1, width)
                base = mine[0]["begin"]
                stretch = F.substr(text, base + 1, F.element_at(mine, -1)["stop"] - base)
                return _named(stretch, lambda s: F.array_join(F.transform(mine, lambda x: F.concat(F.substr(s, x["begin"] - base + 1, x["stop"] - x["begin"]), F.lit("<"), x["kind"], F.lit(">"))), ""))

            return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(F.size(ps) / width).cast("int") - 1), part), ""), F.substr(text, last + 1))

        return _named(pieces, joined)

    return F.when(F.size(findings) > 0, _named(ordered, made)).otherwise(text)


def redacted(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has its findings redacted; ``n_chars``, where there is one, follows. A null text stays null."""
    names = docs.columns
    flat = docs.toDF(*(f"_{i}" for i in range(len(names))))  # so that names that clash do no harm
    at = names.index(text)
    found = find(flat.select(F.struct(*flat.columns).alias("row"), F.col(f"_{at}").alias("text")), "row", "text")
    clean = found.select("row", F.when(F.col(f"row._{at}").isNotNull(), redact(F.col("text"), F.col("findings"))).alias("clean"))
    size = F.length("clean").cast("long")
    return clean.select(*(F.col("clean").alias("c") if i == at else size.alias("c") if n == n_chars else F.col(f"row._{i}").alias("c") for i, n in enumerate(names))).toDF(*names)
