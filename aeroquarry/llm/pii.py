"""Operator 10: personal data by weak supervision.

Candidate spans come from fixed patterns (the base) and looser ones: bracketed
mail addresses, numbers in local notation, and long runs of letters and digits
that may be secrets (keys, tokens). Three labelers vote on each: the pattern's
own check (for secrets: does the run look drawn at random), a gazetteer
(top-level domains, address ranges, issuer numbers, country codes, prefixes of
issued keys) and the words just before the span. Votes are counted by pattern over the whole corpus; expectation-
maximisation turns the counts into labeler reliabilities and a posterior for
each vote pattern; a logistic span classifier is then trained on votes and
shape with those posteriors as soft labels. Base spans always stay; other
candidates are added where the classifier says so. Counts are at most a few
hundred rows for any corpus, so both fits run on the driver; everything else is
DataFrame functions.

Defined results: a null text is empty and has no spans; offsets are code
points, ends exclusive; base matches of one kind never overlap, added spans
never overlap a base span of their kind (secrets: of any kind), and kinds may
overlap each other; spans that start together are ordered by end; very long
texts are searched whole, by patterns that give nothing back; rows with null
ids and repeated rows are searched one by one; an empty table gives an empty
result; further columns pass through ``mask_documents``, whatever their names,
and are ignored by ``find_pii``.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import Scratch

KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the method finds come after those of the base.
ALL_KINDS = (*KINDS, "secret")
#: Equal to the contract's patterns in what they match, but linear: runs are entered
#: at their first character (or where the last match ended), and loops give nothing back.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": f"(?:\\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[ -]?[0-9])++",
    "phone": "\\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\\[(]at[\\])] ?[A-Za-z0-9-]{1,64}(?: ?(?:[\\[(]dot[\\])]|\\.) ?[A-Za-z0-9-]{1,64}){1,5}",
    "phone": "(?<![0-9+(.-])(?:\\([0-9]{3}\\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": "(?<![A-Za-z0-9_-])(?=[A-Za-z_-]{0,40}+[0-9])(?=[0-9_-]{0,40}+[A-Za-z])[A-Za-z0-9_-]{20,200}+(?![A-Za-z0-9_-])",
}
# Gazetteers and context words.
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "info", "eu", "de", "fr", "es", "it", "nl", "uk", "us", "ca", "ch", "at", "pl", "se", "jp", "cn", "in", "br", "mx", "ar", "au")
CARD_PREFIX = "^(4|5[1-5]|2[2-7]|3[47]|35|30|36|38|6011|65|62)"
COUNTRY_PREFIX = "^[+(]?(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
CONTEXT = {
    "email": "(e-?mail|mail|contact|correo|kontakt|courriel|write)[^a-z0-9]*$",
    "ip": "(ip|host|server|address|addr|adresse|from)[^a-z0-9]*$",
    "card": "(card|visa|mastercard|amex|credit|karte|carte|tarjeta)[^a-z0-9]*$",
    "phone": "(phone|tel|telefon|mobile|cell|call|fax|numero)[^a-z0-9]*$",
    "secret": "(token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|key|auth|bearer|credential|credentials)[^a-z0-9]*$",
}
AGAINST = "(version|order|invoice|isbn|serial|id|nr|no|hash|token)[^a-z0-9]*$"
NO_SECRET = "(commit|hash|sha-?[0-9]*|md5|checksum|digest|uuid|version|order|invoice|isbn|serial|id|rev|revision)[^a-z0-9]*$"
KEY_PREFIX = "^(AKIA|ASIA|AIza|ghp_|gho_|ghs_|glpat-|sk-|sk_live_|pk_live_|xox[abp]-|eyJ)"
CONTEXT_CHARS = 24
SPAN = "struct<start:int,end:int,value:string>"
FOUND = "struct<kind:int,start:int,end:int,base:boolean,code:int>"


def _hits(text: Column, pattern: str, guard: Column) -> Column:
    """All matches of ``pattern``; ``guard`` is a cheap necessary condition."""
    return F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _placed(text: Column, pattern: str, hits: Column) -> Column:
    """The matches with code point offsets; the text is only cut where there are any."""
    between = F.split(text, pattern, -1)
    none = F.array().cast(f"array<{SPAN}>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(a, x):
        begin = a["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["hit"].alias("value")))).alias("spans"))

    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.when(F.size(hits) > 0, F.aggregate(pairs, start, step, lambda a: a["spans"])).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def step(acc, i):
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.when(n.between(13, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0).otherwise(False)


def _passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        plain = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, "[.]"), lambda p: F.when(F.length(plain(p)) <= 3, plain(p).cast("int") <= 255).otherwise(False))
    if kind == "card":
        return luhn(_digits(value))
    return F.length(_digits(value)).between(9, 15)


def _random(value: Column) -> Column:
    """Whether a run looks drawn at random: letters and digits, or all three classes of characters, change places often, and few characters repeat."""
    plain = F.regexp_replace(value, "[_-]", "")
    digits = F.size(F.split(plain, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"))
    cases = F.size(F.split(plain, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"))
    often = (digits * 6 >= F.length(plain)) | ((digits + cases) * 3 >= F.length(plain))
    return (F.length(plain) >= 20) & often & (F.size(F.array_distinct(F.split(plain, ""))) >= 8)


def _gazetteer(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lower(F.trim(F.substring_index(F.translate(F.right(value, F.lit(40)), ")]", ".."), ".", -1))).isin(*DOMAINS)
    if kind == "ip":
        return ~value.rlike("^0*(0|2[4-9][0-9]|[3-9][0-9][0-9]|[0-9]{4,})\\.")
    if kind == "card":
        return _digits(value).rlike(CARD_PREFIX)
    if kind == "secret":
        return value.rlike(KEY_PREFIX)
    return value.rlike(COUNTRY_PREFIX)


def _vote(yes: Column, no: Column) -> Column:
    """2: for, 0: against, 1: no vote."""
    return F.when(yes, 2).when(no, 0).otherwise(1)


def _judged(text: Column, kind: str, spans: Column, strict: bool) -> Column:
    """Spans with ``base`` and ``code``: kind, votes and shape packed into one small number."""

    def one(x):
        secret = kind == "secret"
        passes = _passes(kind, x["value"]) if strict else F.lit(False)
        before = F.lower(F.substr(text, F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT_CHARS))))
        own = _vote(_random(x["value"]), F.lit(True)) if secret else _vote(passes, F.lit(strict))
        known = _vote(_gazetteer(kind, x["value"]), F.lit(strict or kind == "email"))  # keys and local numbers need no known prefix: that is no vote against
        near = _vote(before.rlike(CONTEXT[kind]), before.rlike(NO_SECRET if secret else AGAINST))
        size = F.least(F.floor((x["end"] - x["start"]) / 8), F.lit(3)).cast("int")
        parted = x["value"].rlike("[ ()-]").cast("int")
        number = F.lit(ALL_KINDS.index(kind))
        code = ((((number * 3 + own) * 3 + known) * 3 + near) * 4 + size) * 2 + parted
        return F.struct(number.alias("kind"), x["start"].alias("start"), x["end"].alias("end"), passes.alias("base"), code.cast("int").alias("code"))

    return F.transform(spans, one).cast(f"array<{FOUND}>")


def with_found(docs: DataFrame) -> DataFrame:
    """(row, text, found): each row of ``docs`` whole, its text, and every candidate span of it; base spans are marked."""
    rows = docs.select(F.struct("*").alias("row")).withColumn("text", F.coalesce(F.col("row.text"), F.lit("")))
    text = F.col("text")
    some = F.col("digit")
    patterns = {**{k: BASE[k] for k in KINDS}, "email2": LOOSE["email"], "phone2": LOOSE["phone"], "secret2": LOOSE["secret"]}
    guards = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")), "email2": F.contains(text, F.lit("at]")) | F.contains(text, F.lit("at)"))}
    # One projection each for the matches and their places: Spark keeps them apart, as matches are used more than once.
    rows = rows.withColumn("digit", text.rlike("[0-9]"))
    rows = rows.withColumns({f"h_{k}": _hits(text, p, guards.get(k, some)) for k, p in patterns.items()})
    rows = rows.withColumns({f"s_{k}": _placed(text, p, F.col(f"h_{k}")) for k, p in patterns.items()})
    # A run of digits that is too short to be a card can't become one.
    strict = {k: F.filter("s_card", lambda x: F.length(x["value"]) >= 13) if k == "card" else F.col(f"s_{k}") for k in KINDS}
    rows = rows.withColumns({f"j_{k}": _judged(text, k, spans, True) for k, spans in strict.items()})
    taken = lambda x, k: F.exists(F.col(f"j_{k}"), lambda b: b["base"] & (x["start"] < b["end"]) & (b["start"] < x["end"]))
    clear = lambda *kinds: lambda x: ~reduce(lambda a, b: a | b, [taken(x, k) for k in kinds])
    judged = [F.col(f"j_{k}") for k in KINDS]
    judged += [_judged(text, k, F.filter(F.col(f"s_{k}2"), clear(*(KINDS if k == "secret" else (k,)))), False) for k in ("email", "phone", "secret")]
    found = F.greatest(*(F.size(f"s_{k}") for k in patterns)) > 0
    return rows.select("row", "text", F.when(found, F.concat(*judged)).otherwise(F.array().cast(f"array<{FOUND}>")).alias("found"))


def _unpack(code: int) -> tuple[int, tuple[int, int, int], int, int]:
    code, parted = divmod(code, 2)
    code, size = divmod(code, 4)
    code, near = divmod(code, 3)
    code, known = divmod(code, 3)
    kind, own = divmod(code, 3)
    return kind, (own, known, near), size, parted


#: Share of candidates that are taken for personal data before any vote; a learnt one would drift to all or none.
SHARE = 0.3


def reliabilities(counts: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """Posterior of each code by expectation-maximisation over the votes of its kind (0, 1, 2 each; 1: none)."""
    post: dict[int, float] = {}
    for kind in range(len(ALL_KINDS)):
        codes = sorted(c for c in counts if _unpack(c)[0] == kind)
        if not codes:
            continue
        votes = np.array([_unpack(c)[1] for c in codes])
        n = np.array([counts[c] for c in codes], float)
        prior = n.sum() + 3
        p = np.clip(0.5 + 0.2 * (votes - 1).sum(1), 0.05, 0.95)  # starts from the majority
        for _ in range(rounds):
            log = np.full(len(codes), math.log(SHARE / (1 - SHARE)))
            for j in range(votes.shape[1]):
                # The prior weighs as much as all votes: what labelers say keeps its sense where one outcome is rare.
                yes = np.bincount(votes[:, j], n * p, 3) + prior * np.array([0.05, 0.35, 0.6])
                no = np.bincount(votes[:, j], n * (1 - p), 3) + prior * np.array([0.6, 0.35, 0.05])
                log += np.log((yes / yes.sum())[votes[:, j]] / (no / no.sum())[votes[:, j]])
            p = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        post.update(zip(codes, map(float, p), strict=True))
    return post


def span_classifier(counts: dict[int, int], post: dict[int, float], rounds: int = 300) -> set[int]:
    """Codes that a logistic model of kind, votes and shape accepts, trained on the posteriors."""
    codes = sorted(post)
    if not codes:
        return set()

    def features(c: int) -> list[float]:
        kind, votes, size, parted = _unpack(c)
        kinds, shape = [0.0] * len(ALL_KINDS), [0.0] * 5
        kinds[kind], shape[size], shape[4] = 1.0, 1.0, float(parted)
        return kinds + [float(v == w) for v in votes for w in range(3)] + shape

    x, y = np.array([features(c) for c in codes]), np.array([post[c] for c in codes])
    weight = np.sqrt(np.array([counts[c] for c in codes], float))
    weight /= weight.sum()
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta -= 4.0 * (x.T @ (weight * (p - y)) + 1e-3 * beta)
    return {c for c, score in zip(codes, x @ beta, strict=True) if score > 0 and post[c] > 0.5}


def _accepted(found: DataFrame, column: str) -> set[int]:
    """Codes of candidates that the fitted classifier takes; a few hundred counts come back to the driver."""
    rows = found.select(F.explode(f"{column}.code").alias("code")).groupBy("code").count().collect()
    counts = {r["code"]: r["count"] for r in rows}
    return span_classifier(counts, reliabilities(counts))


def _chosen(found: Column, accepted: set[int]) -> Column:
    codes = F.array(*map(F.lit, sorted(accepted))) if accepted else F.array().cast("array<int>")
    kept = F.filter(found, lambda x: x["base"] | F.array_contains(codes, x["code"]))
    return F.sort_array(F.transform(kept, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base"))))


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): array of (kind, start, end, base), by kind, then start; added spans have base false."""
    scratch = Scratch(docs.sparkSession, "pii")
    found = scratch.save(with_found(docs.select("doc_id", "text")).select("row.doc_id", "found"), "found")
    return found.select("doc_id", _chosen(F.col("found"), _accepted(found, "found")).alias("spans"))


def mask_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every span masked; ``n_chars``, where there is one, follows the text. Texts never move: spans are found again."""
    scratch = Scratch(docs.sparkSession, "pii-mask")
    found = scratch.save(with_found(docs.select("text")).select("found"), "found")
    marked = with_found(docs).select("row", _chosen(F.col("found"), _accepted(found, "found")).alias("spans"))
    marked = marked.select("row", "spans", mask(F.col("row.text"), F.col("spans")).alias("masked"))

    def column(name: str) -> Column:
        own = F.col(f"row.`{name}`")
        if name == "text":
            return F.col("masked").alias(name)
        if name == "n_chars":
            return F.when(F.size("spans") > 0, F.length("masked").cast(docs.schema[name].dataType)).otherwise(own).alias(name)
        return own.alias(name)

    return marked.select(*map(column, docs.columns))


def mask(text: Column, spans: Column) -> Column:
    """The text with every span (overlaps merged) replaced by its kind in brackets."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in ALL_KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, s):
        end = -s["minus"]
        gap = F.substr(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        tag = F.when(s["start"] >= a["at"], F.element_at(names, s["kind"] + 1)).otherwise("")
        return F.struct(F.greatest(a["at"], end).alias("at"), F.concat(a["out"], gap, tag).alias("out"))

    end = lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1))
    return F.when(F.size(spans) > 0, F.aggregate(ordered, start, step, end)).otherwise(text)


def spans_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, ALL_KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
