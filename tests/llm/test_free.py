"""Operators 5 to 9 and the pipeline against brute force on small tables."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aeroquarry.llm import classifier, induced_sort, jaccard_join, media, mixing, packing, pii, queries, shingles, suffix_dedup
from test_native import brute_mix, brute_pii, brute_targets

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


EMPTY = []
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


# --- packing -------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(5))
def test_plans_hold_every_item_once(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 4096) if rng.random() < 0.3 else rng.randint(1, 300) for _ in range(2000)), reverse=True)
    place, used, final = packing.cheapest(sizes)
    content = np.bincount(place, sizes, len(used))
    assert content.tolist() == used and all(u <= c for u, c in zip(used, final, strict=True))
    for u, c in zip(used, final, strict=True):
        assert c == min(x for x in packing.LENGTHS if x >= u)
    assert sum(final) <= 1.03 * sum(sizes)


def test_best_fit_takes_the_tightest_bin():
    place, used = packing.best_fit([7, 6, 3, 2, 1], (10,), 1.0)
    assert used == [10, 9] and place == [0, 1, 0, 1, 1]


def test_many_copies_of_one_text_are_packed(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", "s", 0)], DOCS).withColumn("doc_id", F.explode(F.array_repeat(F.lit(1).cast("long"), 2500)))
    out = packing.pack(docs.unionByName(docs_of(spark, ["q"])), shard_items=400).toPandas()
    assert sorted(out[out.doc_id == 1]["copy"]) == list(range(1, 2501)) and (out[out.doc_id == 1].n_words == 3).all() and len(out) == 2501


def brute_best_fit(sizes, lengths, worth, overhead=packing.OVERHEAD):
    """The same rule by looking at every open bin; of equally tight bins the one that was filled last."""
    room, used, place, filled = [], [], [], []
    for turn, size in enumerate(sizes):
        open_ = [(room[b], -filled[b], b) for b in range(len(room)) if room[b] >= size]
        if open_:
            b = min(open_)[2]
        else:
            room.append(min((c + overhead - worth * (c - size), c) for c in lengths if c >= size)[1])
            used.append(0)
            filled.append(0)
            b = len(used) - 1
        filled[b] = turn
        room[b] -= size
        used[b] += size
        place.append(b)
    return place, used


def least_cost(sizes, lengths, overhead):
    """The cheapest packing of all, over every way to part the items."""
    ordered, best = sorted(lengths), {0: 0}
    whole = (1 << len(sizes)) - 1
    total = [sum(s for i, s in enumerate(sizes) if m >> i & 1) for m in range(whole + 1)]
    cost = lambda n: next((c + overhead for c in ordered if c >= n), None)
    for m in range(1, whole + 1):
        low, sub, found = m & -m, m, None
        while sub:
            if sub & low and (own := cost(total[sub])) is not None:
                found = min(found or 10**9, own + best[m ^ sub])
            sub = (sub - 1) & m
        best[m] = found
    return best[whole]


@pytest.mark.parametrize("seed", range(4))
def test_plans_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(40):
        lengths = (16, 32, 64)
        sizes = sorted((rng.randint(1, 64) for _ in range(rng.randint(1, 9))), reverse=True)
        for worth in packing.WORTHS:
            place, used = packing.best_fit(sizes, lengths, worth, 4)
            by_hand = brute_best_fit(sizes, lengths, worth, 4)
            assert (place, used) == by_hand
        _, used, final = packing.cheapest(sizes, lengths, 4)
        best = least_cost(sizes, lengths, 4)
        assert best <= sum(final) + 4 * len(used) <= 1.35 * best


def test_pack_covers_documents(spark):
    texts = [None, "", "a b", " ".join(["w"] * 9000), " ".join(["v"] * 4096)] + [f"x{i} y" for i in range(50)]
    rows = [(i, t, "x", "s", 0) for i, t in enumerate(texts)] + [(2, "a b", "x", "s", 0)] * 3
    out = packing.pack(spark.createDataFrame(rows, DOCS), shard_items=20).toPandas()
    for i, t in enumerate(texts):
        mine = out[out.doc_id == i]
        assert mine.n_words.sum() == len((t or "").split()) * (4 if i == 2 else 1)
    assert sorted(out[out.doc_id == 3].start_word) == [0, 4096, 8192] and out[out.doc_id == 0].bin_id.isna().all()
    bins = out.dropna().groupby("bin_id").agg(n=("n_words", "sum"), used=("bin_used", "max"), cap=("bin_capacity", "max"))
    assert (bins.n == bins.used).all() and (bins.used <= bins.cap).all()
    assert packing.pack(spark.createDataFrame(EMPTY, DOCS)).count() == 0


# --- classifier ------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op6_quality_classifier(spark, sf).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    test = got[got.held_out]
    good, bad = test[test.quality == 1].score, test[test.quality == 0].score
    auc = np.mean([(good > b).mean() + 0.5 * (good == b).mean() for b in bad])
    assert auc > 0.9 and (good >= 0.3).mean() > 0.97


def test_classifier_edge_cases(spark):
    docs = docs_of(spark, [None, "", "   ", "word " * 30_000, "x"])
    none = spark.createDataFrame(EMPTY, "doc_id long, quality int, toxic int")
    assert {r["score"] for r in classifier.classify(docs, none).collect()} == {0.5}
    assert classifier.classify(spark.createDataFrame(EMPTY, DOCS), none).count() == 0
    some = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = classifier.classify(docs.withColumn("score", F.lit("clash")), some).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out) and len({r["score"] for r in out if r["doc_id"] < 3}) == 1


@pytest.mark.parametrize("n", [60, 300, 1500])
def test_dictionaries_take_all_parts_of_texts(n):
    rng = random.Random(n)
    noise = lambda m: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(m))
    passages = [noise(60) for _ in range(3)]  # one early, one in the middle and one at the end of long texts
    texts = [(noise(300) + passages[0] + noise(1500) + passages[1] + noise(900) + passages[2]).encode() for _ in range(n)]
    got = classifier.dictionary(texts)
    assert len(got) <= classifier.DICT_BYTES and all(p[8:-8].encode() in got for p in passages)


def test_dictionaries_of_few_and_uniform_texts():
    assert classifier.dictionary([b"a b", b" ", b"c d"]) == b"a bc d" and classifier.dictionary([b" "]) == b" " * 64
    for texts in (["x" * 500_000], ["word " * 30_000], ["\u00e9" * 80_000, "a"], ["y" * 7] * 40_000):
        assert 0 < len(classifier.dictionary([t.encode() for t in texts])) <= classifier.DICT_BYTES


def test_long_texts_give_pieces_from_start_to_end():
    data = bytes(range(256)) * 8192
    got = classifier.pieces(data)
    assert len(got) == classifier.TEXT_BYTES and got[:64] == data[:64] and got[-64:] == data[-64:] and classifier.pieces(b"abc") == b"abc"


def test_scores_are_calibrated(spark):
    """On the held-out fold: in each fifth of the scores the share of good labels is near the mean score."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = queries.op6_quality_classifier(spark, sf).where("held_out").join(labels, "doc_id").toPandas().dropna()
    brier = float(((got.score - got.quality) ** 2).mean())
    assert brier < 0.5 * got.quality.mean() * (1 - got.quality.mean())
    for _, part in got.groupby(pd.qcut(got.score.rank(method="first"), 5)):
        assert abs(part.score.mean() - part.quality.mean()) < 0.1


def test_folds_choose_what_helps():
    rng = np.random.default_rng(1)
    y = (np.arange(400) % 2).astype(float)
    x = np.zeros((400, classifier.N_FEATURES))
    x[:, 0] = rng.normal(size=400) + 2 * y  # the difference alone tells; the rest is noise
    z = np.column_stack([np.ones(400), x])
    z[:, 2:] = rng.normal(size=(400, classifier.N_FEATURES - 1))
    assert classifier.choose(z, y, np.full(400, 1 / 400), np.arange(400) % 5, 200)[0] == (0,)


# --- suffix arrays and substring dedup ---------------------------------------------


@pytest.mark.parametrize("limit", [1 << 20, 64])
def test_suffix_arrays(limit, tmp_path):
    rng = np.random.default_rng(7)
    written = 0
    for _ in range(60):
        parts = [np.r_[rng.integers(1, 1 + rng.integers(1, 5), rng.integers(1, 25)), 0] for _ in range(rng.integers(1, 8))]
        t = np.concatenate(parts).astype(np.uint16)
        ends = np.flatnonzero(t == 0)
        end = lambda i: int(ends[np.searchsorted(ends, i)])  # noqa: E731, B023
        want = sorted(range(len(t)), key=lambda i: (t[i : end(i)].tolist() + [0], end(i)))  # noqa: B023
        order, shared = induced_sort.suffix_array(t, f"file://{tmp_path}", limit)
        common = lambda a, b: next(k for k in range(len(t)) if t[a + k] != t[b + k] or t[a + k] == 0)  # noqa: E731, B023
        assert order.tolist() == want and shared.tolist() == [0] + [common(a, b) for a, b in zip(want[1:], want, strict=False)]
        written += induced_sort.sort_suffixes(t, f"file://{tmp_path}", lambda *_: None, limit)
    assert (written > 0) == (limit == 64) and not list(tmp_path.iterdir())  # run files are gone


def test_the_querys_queues_go_to_files(tmp_path):
    """A shard of the size that the query sorts, under the query's own limit."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    texts = [(" ".join(rng.choice(words) for _ in range(20)))[:80].encode() for _ in range(suffix_dedup.SHARD_BYTES // 80)]
    sizes = np.array([len(t) for t in texts], np.int64)
    which, start, written = suffix_dedup.repeated(np.arange(len(texts)), sizes, np.frombuffer(b"".join(texts), np.uint8), f"file://{tmp_path}")
    assert written > 4 * suffix_dedup.QUEUE_BYTES and not list(tmp_path.iterdir())
    first, want = {}, []
    for i, t in enumerate(texts):
        for j in range(len(t) - 49):
            if first.setdefault(t[j : j + 50], i) < i:
                want.append((i, j))
    assert list(zip(which.tolist(), start.tolist(), strict=True)) == want


def brute_dedup(rows, length=50):
    first, out = {}, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for j in range(len(raw) - length + 1):
            if first.setdefault(raw[j : j + length], i) < i:
                gone[j : j + length] = b"\1" * length
        runs = sum(1 for j in range(len(raw)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def test_dedup_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(12)]
    texts = [None, "", "x" * 49, "x" * 50, "x" * 400, "ab" * 300, "y" * 50 + "x" * 50]
    for _ in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        texts.append(" ".join(parts))
    for t in list(texts[10:40]):  # near copies: one byte changed here and there
        cut = rng.randrange(max(1, len(t)))
        texts.append(t[:cut] + "#" + t[cut + 1 :])
    texts += texts[20:30] * 2
    rows = list(enumerate(texts)) + [(25, texts[25])]
    for small in (False, True):
        if small:
            for name in ("FLUSH_BYTES", "BUCKET_BYTES", "GROUP_BYTES", "SHARD_BYTES", "QUEUE_BYTES"):
                monkeypatch.setattr(suffix_dedup, name, 3000)
            monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 2)  # anchors are split
        docs = spark.createDataFrame([(i, t, "x", "s", 0) for i, t in rows], DOCS).repartition(5)
        got = sorted(tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect())
        assert got == brute_dedup(rows)
    assert suffix_dedup.suffix_dedup(spark.createDataFrame(EMPTY, DOCS)).count() == 0


def test_dedup_on_the_tables(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in queries.op7_suffix_array_dedup(spark, SF).collect()) == brute_dedup(rows)


# --- media --------------------------------------------------------------------------


def test_media_round_trip(spark):
    texts = [None, "", "a", "é" * 32, "z" * 64, "q" * 65, "same", "same", "big " * 40_000]
    for r in media.media(docs_of(spark, texts).withColumn("digest", F.lit(1))).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(payload)) and r["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(payload[-64:]) and (r["width"], r["height"], r["bit_depth"]) == (64, len(payload) // 64, 8)
        image = media.encode(payload)
        assert (r["media_bytes"], r["media_sha256"]) == (len(image), hashlib.sha256(image).hexdigest()) and media.decode(image).tobytes() == payload
    assert media.media(spark.createDataFrame(EMPTY, DOCS)).count() == 0


def test_damaged_images_are_found():
    image = bytearray(media.encode(b"x" * 64))
    image[50] ^= 1
    with pytest.raises(Exception):  # noqa: B017
        media.decode(bytes(image))


# --- similarity join ------------------------------------------------------------------


def brute_join(rows, k, pct):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(LOWER).split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def varied(seed, n):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(4000)}" for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 120]))) for _ in range(n)]
    texts = [None, "", " ", "A b C d", "a B c D", "a b c"]
    for t in base:
        words = t.split()
        texts.append(t)
        for _ in range(rng.randrange(4)):
            w = list(words)
            for _ in range(rng.randrange(1 + len(w) // 12)):
                w[rng.randrange(len(w))] = f"w{rng.randrange(4000)}"
            texts.append(rng.choice([" ", "  ", "\n"]).join(w).upper() if rng.random() < 0.2 else " ".join(w))
    return texts


@pytest.mark.parametrize(("k", "pct"), [(4, 85), (5, 80), (1, 50)])
def test_join_against_brute_force(spark, monkeypatch, k, pct):
    texts = varied(k, 60)
    for name in ("FLUSH_GRAMS", "BUCKET_GRAMS", "GROUP_GRAMS"):
        monkeypatch.setattr(jaccard_join, name, 700)
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 4)  # clusters are checked in blocks
    out = jaccard_join.jaccard_join(docs_of(spark, texts).repartition(4), k, pct).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in out) == brute_join(list(enumerate(texts)), k, pct)


@pytest.mark.parametrize("pct", [25, 34, 50, 51, 60, 85])
def test_linked_sets_share_a_key_at_any_boundary(pct):
    for edge in (0, 1, 4, 5, 8, 64):
        for n in range(1, 25):
            for m in range(1, n + 1):
                both = -(-pct * (n + m) // (100 + pct))  # the least intersection that links
                if both > m:
                    continue
                rows = []
                for node, size in ((1, n), (2, m)):  # what they share comes last in both orders
                    grams = np.array([1000 * node + i for i in range(size - both)] + [5000 + i for i in range(both)], np.int64)
                    share = min(2, jaccard_join.least_overlap(size, pct))
                    single, pair = jaccard_join.prefix(size, pct), jaccard_join.prefix(size, pct, share)
                    rows.append((node, size, single, pair, grams[: max(single, pair)]))
                out = next(jaccard_join._keys(pct, edge)([pd.DataFrame(rows, columns=["node", "n", "single", "pair", "rare"])]))
                assert set(out.key[out.node == 1]) & set(out.key[out.node == 2]), (edge, n, m)


def test_join_of_nothing_and_of_repeats(spark):
    assert jaccard_join.jaccard_join(spark.createDataFrame(EMPTY, DOCS)).count() == 0
    rows = [(4, "a b c d e", "x", "s", 0)] * 3 + [(7, "a b c d e", "x", "s", 0), (9, None, "x", "s", 0), (8, None, "x", "s", 0)]
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(4, 4)] * 3 + [(7, 4), (8, 8), (9, 9)]


def test_subsets_and_lists_agree():
    rows = [(n, 10.0 * n, 5.0 * n) for n in range(1, 60)]
    assert jaccard_join.boundary(rows, 85) == 0 and jaccard_join.boundary([(n, 1.0, 50.0) for n in range(1, 60)], 85) > 40


def test_shingle_hashes_follow_words():
    texts = ["a b c d e", None, "A\tB  c\x0bd e", "a b c d f", "", "a b c d e", "a", "ab"]
    plain = list(shingles.sets(pa.array(texts), 4))
    assert (plain[0] == plain[2]).all() and [len(s) for s in plain] == [2, 0, 2, 2, 0, 1, 1, 1]
    assert len(np.intersect1d(plain[0], plain[3])) == 1 and plain[6][0] != plain[7][0]
    long = [" ".join(f"t{i}" for i in range(300_000)), "a b c d e"]
    again = list(shingles.sets(pa.chunked_array([long]), 4))
    assert len(again[0]) == 299_997 and (again[1] == plain[0]).all()


# --- pipeline ----------------------------------------------------------------------------


def masked_by_hand(text, spans):
    out, at = [], 0
    for start, end, kind in sorted((s["start"], -s["end"], s["kind"]) for s in spans):
        if start >= at:
            out += [text[at:start], f"[{pii.ALL_KINDS[kind].upper()}]"]
        at = max(at, -end)
    return "".join(out) + text[at:]


def test_pipeline_against_brute_force(spark):
    """Each stage against a plain version on the rows that the stage before left, and the whole run against the stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = classifier.train(docs, labels, ~classifier.held_out(F.col("doc_id")))
    sizer = classifier.Sizer(model.good, model.bad)
    good = sorted(r["doc_id"] for r in docs.collect() if model.score(np.array([sizer.features(r["text"])]))[0] >= 0.3)
    kept = corpus_pipeline.quality(spark, docs, SF).cache()
    assert kept.columns == columns and sorted(r["doc_id"] for r in kept.collect()) == good and len(good) < docs.count()

    single = corpus_pipeline.near_duplicates(spark, kept, SF).cache()
    want = sorted(i for i, _, c in brute_join([(r["doc_id"], r["text"]) for r in kept.collect()], 5, 80) if i == c)
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == want and len(want) < len(good)

    masked = corpus_pipeline.personal_data(spark, single, SF).cache()
    spans = {r["doc_id"]: r["spans"] for r in pii.find_pii(single).collect()}
    text_of = {r["doc_id"]: masked_by_hand(r["text"] or "", spans[r["doc_id"]]) for r in single.collect()}
    assert masked.columns == columns and {r["doc_id"]: r["text"] or "" for r in masked.collect()} == text_of
    for r in single.collect():  # the base is found by hand too
        found = {(s["start"], s["end"]) for s in spans[r["doc_id"]] if s["base"]}
        assert found == {tuple(map(int, x.split(":")[1:])) for x in brute_pii(r["text"])}

    mixed = corpus_pipeline.mixture(spark, masked, SF).cache()
    plan = mixing.Mix(masked)
    sized = plan.sized.collect()
    aims = {r["__s"]: r["target"] for r in plan.aims.collect()}
    assert aims == {s: pytest.approx(t) for s, t in brute_targets({r["source"]: sum(x["size"] for x in sized if x["source"] == r["source"]) for r in sized}).items()}
    copies = brute_mix([(r["source"], r["doc_id"], r["size"], 2.0 ** (r["step"] / mixing.STEPS), r["u"]) for r in sized], aims)
    taken = {r["doc_id"]: n for r, n in zip(sized, copies, strict=True) if n}
    assert mixed.columns == columns and {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == taken

    out = corpus_pipeline.packed(spark, mixed, SF).toPandas()
    items = sorted((-min(n - 4096 * k, 4096), i, k, c) for i, t in taken.items() for n in [len(text_of[i].encode().split())] for c in range(1, t + 1) for k in range(-(-n // 4096)))
    place, used, final = packing.cheapest([-x[0] for x in items])
    got = {(r.doc_id, r.piece, r.copy): (r.n_words, r.bin_id, r.bin_capacity, r.bin_used) for r in out.dropna().itertuples()}
    assert got == {(i, k, c): (-n, b, final[b], used[b]) for (n, i, k, c), b in zip(items, place, strict=True)}
    rows = lambda d: sorted(map(str, d.astype("Float64").itertuples(index=False)))
    assert rows(corpus_pipeline.run(spark, SF).toPandas()) == rows(out)


def test_near_duplicates_with_null_and_shared_ids(spark):
    rng = random.Random(5)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(9999)}" for _ in range(100)) for _ in range(5))
    near = lambda t: t + " more"
    rows = [(None, a), (None, b), (None, near(b)), (7, c), (7, d), (7, near(c)), (9, near(d)), (3, near(a)), (4, e), (4, e), (None, e), (None, None), (None, None), (8, ""), (7, "x y")]
    for repeated in (rows, [r for n, r in enumerate(rows) if n != 9]):  # with and without a repeated row elsewhere
        docs = spark.createDataFrame([(i, t, "x", "s", 0) for i, t in repeated], DOCS).repartition(3)
        got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
        of = lambda *texts: [r for r in got if r[1] in texts]  # noqa: B023, E731
        assert of(a, near(a)) == [(3, near(a))] and of(e) == [(4, e)] and of("x y") == [(7, "x y")]
        assert len(of(b, near(b))) == 1 and of(b, near(b))[0][0] is None
        assert len(of(c, near(c))) == 1 and of(d, near(d)) == [(7, d)]
        assert len(of(None, "")) == 3 and len(got) == 9


def test_pipeline_of_nothing_and_odd_rows(spark):
    extra = "doc_id long, text string, lang string, source string, n_chars long, score double, node long"
    odd = [(1, None, None, None, None, 1.0, 2), (1, None, None, None, None, 1.0, 2), (2, "", "x", "s", 0, None, None), (3, "w " * 30_000, "x", "s", 60_000, 0.0, 1)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, extra)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs.count()
            if name != "best-fit packing":
                assert docs.columns == [c.split()[0] for c in extra.split(", ")], name
