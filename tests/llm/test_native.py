"""Operators 1 to 4 and 10 against brute force on small tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroquarry.llm import chat, mixing, pii, quality_rules, queries, url_filters

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], DOCS)


def brute_measure(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


EDGE_TEXTS = [None, "", " \t\n", "a", "a b c d e a b c d e", "x " * 300, "l\nl\n\nl \nl", "\u00a0 \u2003é", "#*$%&|<> #", "w" * 50_000, " ".join(f"t{i % 7}" for i in range(12_000))]


def test_quality_measures(spark):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs_of(spark, EDGE_TEXTS)).collect()}
    assert len(got) == len(EDGE_TEXTS)
    for i, t in enumerate(EDGE_TEXTS):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_measure(t)
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])


def test_long_texts_take_the_array_path(monkeypatch):
    words = (" ".join(f"t{i % 97} u{i % 13}" for i in range(4000))).encode().split()
    plain = quality_rules.repeated_words(words)
    monkeypatch.setattr(quality_rules, "LONG_WORDS", 10)
    assert quality_rules.repeated_words(words) == plain


def test_host_verdict_reaches_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, good if i % 10 == 0 else "bad", "x", "spam", 1) for i in range(300)] + [(1000 + i, good, "x", f"h{i % 20}", 1) for i in range(400)] + [(2000, good, "x", None, 1)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert not got[0]["base_failed"] and not got[0]["kept"]
    assert all(got[1000 + i]["kept"] for i in range(400)) and got[2000]["kept"]


def test_hosts_fall_by_rules_that_spare_single_documents(spark):
    """Symbols and repeated lines fail no document by themselves, but a host that is full of them goes."""
    plain = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    lines = lambda i: "menu\n" * 8 + plain(i)
    rows = [(i, lines(i), "x", "menus", 1) for i in range(100)] + [(500 + i, plain(i) + " #$%&" * 10, "x", "signs", 1) for i in range(100)]
    rows += [(1000 + i, lines(i) if i % 25 == 0 else plain(i), "x", f"h{i % 20}", 1) for i in range(2000)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert {i for i, r in got.items() if not r["kept"]} == {*range(100), *range(500, 600)}


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def test_url_rules(spark):
    urls = [None, "", "x", "http://A.Example.NET/en/1?q", "http://example.net/de/1", "https://notexample.net/en/", "http://example.com/de/#x", "http://a.example.com/de", "http://a.org/fr/9", "http://org/fr/", "http://x.org?a/fr/", "http://É.net/", "a://b://c/d"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filters.url_filter(pages, spark.createDataFrame([], "host string, bad boolean"), queries.URL_RULES).collect()}
    for i, url in enumerate(urls):
        host, path = brute_url(url)
        fits = [(h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda r: len(r[0]), default=(None, "allow"))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict)


def test_bad_hosts_are_blocked(spark):
    rows = [("bad.example.com", True)] * 80 + [(f"h{i}.example.com", i % 9 == 0) for i in range(40) for _ in range(20)] + [("few.example.org", True)]
    rep = {r["host"]: r for r in url_filters.reputation(spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    assert rep["bad.example.com"]["above"] > 0.95 > rep["few.example.org"]["above"]
    assert 0 < rep["few.example.org"]["rate"] < 1


def test_posterior_probabilities(spark):
    """The incomplete beta function against a sum over its density."""
    cases = [(a, b, x) for a in (0.02, 0.4, 1.0, 3.5, 40.0, 900.0) for b in (0.3, 1.0, 7.0, 250.0, 5000.0) for x in (0.02, 0.2, 0.5, 0.9)] + [(15_000.0, 30_000.0, 0.33), (15_000.0, 30_000.0, 0.34)]
    df = spark.createDataFrame(cases, "a double, b double, x double")
    w = np.log((np.arange(400_000) + 0.5) / 400_000)
    for r in df.withColumn("p", url_filters.probability_below(F.col("a"), F.col("b"), F.col("x"))).collect():
        a, b, x = r["a"], r["b"], r["x"]
        ends = lambda a, b, x: np.exp((a - 1) * (np.log(x) + 90 * w) + (b - 1) * np.log1p(-x * np.exp(90 * w)) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + math.log(90 * x) + 89 * w).mean()
        want = ends(a, b, x) if a >= b * x else 1 - ends(b, a, 1 - x)
        assert r["p"] == pytest.approx(want, abs=2e-3), (a, b, x)


def test_long_rule_lists_are_joined(spark):
    rng = random.Random(1)
    hosts = [f"{a}.{b}" for a in "abcdef" for b in ("net", "org", "co.uk")]
    rules = [(rng.choice([h, f"s.{h}", h.split(".", 1)[1]]), rng.choice(["/", "/x/", "/x/y", f"/p{i}"]), rng.choice(["allow", "block"])) for i in range(3) for h in hosts]
    rules += [(f"none{i}.example", "/", "block") for i in range(url_filters.MAX_RULES)]
    urls = [None, "bad", *(f"http://{s}{h}{p}" for h in hosts for s in ("", "s.", "t.s.", "x") for p in ("", "/", "/x/", "/x/y/z", "/p1?q"))]
    parts = url_filters.with_parts(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    joined = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filters.with_rule(parts, rules).collect()}
    for i, url in enumerate(urls):
        host, path = brute_url(url)
        fits = [(len(h) + len(p), h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, h, p, v = max(fits, default=(0, None, None, None))
        assert joined[i] == (h + p if h else None, v), url


def test_hosts_without_labels_follow_their_domain(spark):
    rows = [(f"s{i}.bad.com", True) for i in range(30) for _ in range(20)] + [(f"s{i}.good{i % 5}.com", i == 0) for i in range(30) for _ in range(20)]
    rows += [(f"s{i}.d{i % 6}.spam", True) for i in range(30) for _ in range(20)] + [(f"s{i}.e{i % 6}.org", False) for i in range(30) for _ in range(20)]
    want = {"new.bad.com": "block", "new.good1.com": "allow", "new.fresh.spam": "block", "new.fresh.org": "allow", "new.fresh.none": "allow", "s1.bad.com": "block", "s1.good1.com": "allow"}
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(want)], "page_id long, url string")
    outcomes = spark.createDataFrame(rows, "host string, bad boolean")
    assert {r["host"]: r["verdict"] for r in url_filters.url_filter(pages, outcomes, ()).collect()} == want
    rep = {r["host"]: r for r in url_filters.reputation(outcomes, others=spark.createDataFrame([(h,) for h in want], "host string")).collect()}
    assert rep["new.bad.com"]["n"] == 0 and rep["s1.bad.com"]["n"] == 20 and rep["new.fresh.none"]["rate"] == pytest.approx(sum(b for _, b in rows) / len(rows))


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if left * w[s] / total > 2 * sizes[s]}
        if not full:
            target |= {s: left * w[s] / total for s in open_}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def test_mixing_meets_targets(spark):
    rows = []
    for s, n in (("b", 400), ("a", 30), (None, 55), ("c", 8), ("d", 200), ("é", 3), ("z", 1)):
        rows += [(len(rows) + i, " ".join("w" for _ in range(i * 7 % 90)), "x", s, 1) for i in range(n)]
    rows += [rows[5], rows[5], (10_001, None, "x", "a", 0)]
    out = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    sizes, taken, aim = Counter(), Counter(), {}
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        aim[r["source"]] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    want = brute_targets(sizes)
    for s in sizes:
        assert aim[s] == pytest.approx(want[s]) and abs(taken[s] - aim[s]) <= 45, s
    again = sorted((r["doc_id"], r["taken"]) for r in mixing.mix(spark.createDataFrame(rows[::-1], DOCS)).collect())
    assert again == sorted((r["doc_id"], r["taken"]) for r in out)


def brute_mix(rows, targets, most=2):
    """Pareto sampling by sorting, from (source, doc_id, size, measure, u): copies of each row."""
    copies = [0] * len(rows)
    for source, target in targets.items():
        own = [i for i, r in enumerate(rows) if r[0] == source]
        lo, hi = 0.0, 1e9
        for _ in range(200):  # the factor, by bisection
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(mid * rows[i][3], most) * rows[i][2] for i in own) < target else (lo, mid)
        words, rest = 0, []
        for i in own:
            e = min(hi * rows[i][3], most)
            whole = math.floor(e + 1e-9)
            copies[i], f, u = whole, e - whole, rows[i][4]
            words += whole * rows[i][2]
            if f > 1e-9:
                rest.append((u * (1 - f) / (f * (1 - u)), rows[i][1], u, i))
        left = target - words
        for *_, i in sorted(rest):
            if left <= 0 or left < rows[i][2] / 2:
                break
            copies[i] += 1
            left -= rows[i][2]
    return copies


@pytest.mark.parametrize("measure", [None, "weight"])
def test_mixing_against_sorting(spark, measure):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([1, 5, 20, 60, 300])), rng.choice(["a", "a", "a", "b", "c"]), rng.choice([0.5, 1.0, 4.0, 16.0, -1.0, None, float("nan")])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")
    plan = mixing.Mix(docs, measure=measure)
    sized = {r["doc_id"]: r for r in plan.sized.collect()}
    out = sorted(plan.decide(plan.ranked).select("doc_id", "source", "target", "copies", "e").collect(), key=lambda r: r["doc_id"])
    got = [r["copies"] for r in out]
    brute = [(r["source"], r["doc_id"], r["size"], 2.0 ** (r["step"] / mixing.STEPS), r["u"]) for _, r in sorted(sized.items())]
    assert got == brute_mix(brute, {r["source"]: r["target"] for r in out})
    assert len({round(r["e"], 6) for r in out if r["source"] == "a"}) > 1  # odds differ within a source


def test_inclusion_follows_the_measure(spark):
    """Rows are taken as often as their expected copies say."""
    rows = [(i, "a b c d e f g h", "s" if i < 3000 else "t", float(1 + i % 3)) for i in range(6000)]
    plan = mixing.Mix(spark.createDataFrame(rows, "doc_id long, text string, source string, weight double"), weights=(1, 2), share_pct=90, measure="weight")
    seen, want = Counter(), {}
    for r in plan.decide(plan.ranked).collect():
        seen[r["doc_id"] % 3, r["source"]] += r["copies"]
        want[r["doc_id"] % 3, r["source"]] = r["e"]
    assert len({round(e, 3) for e in want.values()}) > 4
    for key, e in want.items():
        assert seen[key] / 1000 == pytest.approx(e, abs=0.08), key


def test_repeated_rows_are_cut_near_the_target(spark):
    rows = [(i, "w " * (3 + i % 7), "x", "s", 1) for i in range(50)] + [(99, "a b c d e f g h i j", "x", "s", 1)] * 2500 + [(7, "q r s", "x", "t", 1)] * 3
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    for s in ("s", "t"):
        taken, target = sum(r["taken"] for r in out if r["source"] == s), next(r["target"] for r in out if r["source"] == s)
        assert abs(taken - target) <= 5, s
    assert all(r["copies"] <= 2 for r in out) and len({r["copies"] for r in out if r["doc_id"] == 99}) == 2
    many = mixing.repeat_by_mix(docs)
    assert many.columns == docs.columns and many.groupBy("doc_id").count().where("doc_id = 99").first()["count"] == sum(r["copies"] for r in out if r["doc_id"] == 99)


def test_mixing_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert [r["taken"] for r in mixing.mix(docs_of(spark, [None, ""])).collect()] == [0, 0]


def test_repeated_documents_have_all_columns(spark):
    docs = docs_of(spark, [" ".join("w" * (1 + i % 5)) for i in range(60)])
    out = mixing.repeat_by_mix(docs)
    assert out.columns == docs.columns
    words = sum(len(t["text"].split()) for t in out.collect())
    assert words == sum(r["taken"] for r in mixing.mix(docs).collect())


def test_chat_round_trip(spark):
    turns = [(1, 0, "user", "hi <turn> \\l \\b \\\\"), (1, 1, "assistant", "</turn>\n<turn>user\n\\"), (1, 2, "assistant", ""), (2, 5, None, None), (2, 5, "assistant", "é\U0001f600"), (None, 1, "a\nb", "c"), (3, 0, "assistant", "x"), (3, 0, "assistant", "x"), *((4, 7, "user", t) for t in "edcab")]
    turns += [(9, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(70)]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    links, messages = chat.chain(rows)
    got = {r["tree_id"]: r for r in chat.read_back(chat.format_paths(messages, chat.best_paths(links))).collect()}
    convs = {}
    for c, n, role, text in sorted(turns, key=lambda r: (r[0] or 0, r[1], r[2] or "", hashlib.sha256((r[3] or "").encode()).hexdigest())):
        convs.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(convs)
    for c, said in convs.items():
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == said
        assert got[c]["loss_text"] == "".join(t for r, t in said if r == "assistant")


def test_best_branch_wins(spark):
    tree = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 2.0), ("t", 4, 2, "user", "c", 5.0), ("t", 5, 3, "user", "d", 1.0), ("u", 1, 2, "user", "x", 0.0), ("u", 2, 1, "user", "y", 0.0)]
    messages = spark.createDataFrame(tree, "tree_id string, node_id long, parent_id long, role string, text string, score double")
    path = chat.best_paths(messages, top=2)
    out = chat.read_back(chat.format_paths(messages, path)).orderBy("rank").collect()
    assert [[t["text"] for t in r["turns"]] for r in out] == [["q", "a", "c"], ["q", "b", "d"]]  # tree u is a cycle
    assert [r["node_id"] for r in chat.best_paths(messages).orderBy("depth").collect()] == [1, 2, 4]


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += (2 * d - 9 if 2 * d > 9 else 2 * d) if i % 2 else d
    return total % 10 == 0


def brute_pii(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            v, digits = m.group(), re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in v.split(".")) if kind == "ip" else 0, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PII_TEXTS = [
    None, "", "a.b@c.d_e@f.g.h i@j k@l.m@n.o", "@x.y a@b-.c", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 5500005555555559 4111  111111111111",
    "+1 (499) 555-6503 +12 +123456789 +1(2).3-4 5 6 7 8 9 0+33 1 22 33 44 55 66 77", "\U0001f600é 10.0.0.1 x@y.z", "9" * 30_000, "1." * 20_000, "a" * 60_000 + "@b" + ".c" * 9000,
    "call 499 555-6503 now, mail bob [at] site [dot] com", "+" * 5000 + "1", "1 " * 8000,
]


def test_pii_base_spans(spark):
    rows = pii.find_pii(docs_of(spark, PII_TEXTS)).select("doc_id", pii.spans_text(F.filter("spans", lambda s: s["base"])).alias("b"), pii.spans_text(F.col("spans")).alias("a")).collect()
    for r in rows:
        assert (r["b"].split(",") if r["b"] else []) == brute_pii(PII_TEXTS[r["doc_id"]]), r["doc_id"]
        assert set(r["b"].split(",")) <= set(r["a"].split(",")) or not r["b"]


def test_pii_on_the_tables(spark):
    got = {r["doc_id"]: r for r in queries.op10_pii(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        base = brute_pii(d["text"])
        assert got[d["doc_id"]]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [got[d["doc_id"]][f"n_{k}"] for k in BASE] == [sum(b.startswith(k) for b in base) for k in BASE]


def test_labelers_agree_on_reliability():
    code = lambda own, known, near: (((0 * 3 + own) * 3 + known) * 3 + near) * 8
    post = pii.reliabilities({code(2, 2, 2): 500, code(2, 2, 1): 300, code(0, 0, 0): 400, code(0, 2, 1): 50, code(1, 0, 0): 30})
    assert post[code(2, 2, 2)] > 0.9 > 0.1 > post[code(0, 0, 0)]


def test_added_spans_are_right(spark):
    """Precision and recall of what the method adds to the base, on planted cases and look-alikes."""
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("aeioustrnl") for _ in range(rng.randint(3, 8)))
    planted, alike = [], []
    for i in range(60):
        local = f"{rng.randint(200, 999)} {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        planted += [("token = ", hexes(40)), ("api_key: ", mixed(32)), ("password=", mixed(24)), ("call ", local), ("mail ", f"{word()} [at] {word()} [dot] com")]
        alike += [("commit ", hexes(40)), ("sha256: ", hexes(64)), ("version ", f"v{i}-" + "-".join(word() for _ in range(5))), ("see ", "-".join([word() for _ in range(4)] + [str(2000 + i)])), ("order ", f"{rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)}")]
    texts, want = [], set()
    for d, (cue, value) in enumerate(planted + alike):
        head = " ".join(word() for _ in range(6)) + " " + cue
        texts.append(head + value + " " + word())
        if d < len(planted):
            want.add((d, len(head), len(head) + len(value)))
    got = {(r["doc_id"], s["start"], s["end"]) for r in pii.find_pii(docs_of(spark, texts)).collect() for s in r["spans"] if not s["base"]}
    recall, precision = len(got & want) / len(want), len(got & want) / len(got)
    assert recall >= 0.95 and precision >= 0.9, (recall, precision, sorted(got - want)[:5], sorted(want - got)[:5])


def test_masking(spark):
    text = "x a@b.c, 4111 1111 1111 1111!"
    df = docs_of(spark, [text, "clean"])
    spans = pii.find_pii(df).withColumnRenamed("doc_id", "i")
    out = {r["doc_id"]: r["m"] for r in df.join(spans, F.col("doc_id") == F.col("i")).select("doc_id", pii.mask(F.col("text"), F.col("spans")).alias("m")).collect()}
    assert out == {0: "x [EMAIL], [CARD]!", 1: "clean"}
