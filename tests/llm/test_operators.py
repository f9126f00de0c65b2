"""Each operator against a brute-force version on a small table with edge cases."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from sectionmap.llm import (chat, common, decontaminate, jaccard_join, language, line_dedup, mixing, quality_classifier, quality_rules,
                            sharding, suffix_dedup)
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def test_mix_meets_targets(edge_docs):
    got = mixing.mix(edge_docs).collect()
    sizes = {d: len(WORD.findall(t or "")) for d, t in texts(edge_docs)}
    assert all(r["size"] == sizes[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"] for r in got)
    per = collections.defaultdict(lambda: [0, 0, 0.0, 10**9])
    for r in got:
        p = per[r["source"]]
        p[0], p[1], p[2], p[3] = p[0] + r["size"], p[1] + r["taken"], r["target"], min(p[3], r["size"] or 10**9)
    assert abs(sum(p[2] for p in per.values()) - 1.5 * sum(p[0] for p in per.values())) < 1e-6
    order = sorted(per, key=lambda s: (s is None, s or ""))
    open_ = [(s, [3, 1, 2][i % 3]) for i, s in enumerate(order) if per[s][2] < 2 * per[s][0] - 1e-9]
    level = {round(per[s][2] / w, 6) for s, w in open_}
    assert len(level) <= 1
    for p in per.values():
        assert p[2] <= 2 * p[0] + 1e-9 and abs(p[1] - p[2]) <= max(p[0] * 0.5, 2)
    again = mixing.mix(edge_docs.repartition(5)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))


def test_quality_counts(edge_docs):
    got = {r["doc_id"]: r for r in quality_rules.judge(edge_docs).collect()}
    for d, t in texts(edge_docs):
        t = t or ""
        w = WORD.findall(t)
        win = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        hit = {j for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (
            len(w), sum(map(len, w)), len(hit), len(lines) - len(set(lines)))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(hit) > 20 * len(w)) and not (r["kept"] and r["base_failed"])


def test_em_finds_the_bad_cluster():
    good, bad, prior = (1, 1, 1), (-1, -1, 1), None
    prior, acc = quality_rules.fit([(good, 900), (bad, 100), ((0, 1, 1), 50)])
    assert quality_rules.posterior(prior, acc, good) > 0.9 > 0.5 > quality_rules.posterior(prior, acc, bad)


def test_sharding_is_even(edge_docs):
    got = sharding.shard_documents(edge_docs, shards=5).collect()
    n = collections.Counter(r["shard"] for r in got)
    assert len(got) == 25 and max(n.values()) - min(n[s] for s in range(5)) <= 1
    for s in n:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n[s]))
    for r, t in ((r, dict(texts(edge_docs))[r["doc_id"]] or "") for r in got):
        assert r["size"] == len(t.encode()) + 8 and r["text_crc32"] == zlib.crc32(t.encode())
    # A group moves as one, as far as a shard has room for it.
    assert len({r["shard"] for r in got if r["doc_id"] in (1, 2)}) == 1


def test_sharding_by_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(400)], "doc_id long, text string")
    load = collections.Counter()
    for r in sharding.shard_documents(docs, shards=4, law="bytes").collect():
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) <= 2 * 58


def test_line_dedup(edge_docs):
    docs = edge_docs.dropDuplicates(["doc_id"])
    key = lambda l: l.strip(" \t\n\x0b\x0c\r").translate(LOW)
    seen = collections.Counter(k for _, t in texts(docs) for k in {key(l) for l in (t or "").split("\n")})
    for r in line_dedup.dedup_lines(docs, min_docs=10, batches=3).collect():
        lines = (dict(texts(docs))[r["doc_id"]] or "").split("\n")
        kept = [l for l in lines if not key(l) or seen[key(l)] < 10]
        assert (r["n_lines"], r["n_dropped"], r["kept"]) == (len(lines), len(lines) - len(kept), "\n".join(kept))


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\</s>\\\\", "<</s>[ROLE]\\[INST]", None, "", "<<SYS>>\\"]
    turns = [(c, i, role, nasty[(c + i) % 6]) for c in range(6) for i, role in enumerate(("user", "assistant", "user", "assistant"))]
    turns += [(9, 0, "system", "s"), (9, 1, "tool[/ROLE]", "x"), (9, 2, None, "y"), (10, 0, "assistant", "z")]
    out = chat.format_chats(spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, valid int"))
    read = out.select("conv_id", "valid", "segments", chat.read_chats(F.array_join(F.transform("segments", lambda s: s["text"]), "")).alias("t"))
    for r in read.collect():
        want = [((role or ""), (text or "")) for c, _, role, text in turns if c == r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["t"]] == want
        assert r["valid"] == (r["conv_id"] < 6)
        assert sum(s["loss"] for s in r["segments"]) == sum(role == "assistant" for role, _ in want)


def brute_matches(docs, items, width):
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pat.findall((t or "").translate(LOW))
    wins = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(len(w), width)
        for j in range(len(w) - n + 1 if w else 0):
            wins[tuple(w[j:j + n])].add(i)
    out = {}
    for d, t in docs:
        w, hit, got = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in wins:
                    hit |= set(range(j, j + n))
                    got |= wins[tuple(w[j:j + n])]
        out[d] = (len(w), len(hit), sorted(got))
    return out


def longest_matches(doc, items, width):
    """(item, place, start, words) of every run of equal words that cannot grow, of a window's length at least."""
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    d, out = pat.findall((doc or "").translate(LOW)), []
    for i, t in items:
        w = pat.findall((t or "").translate(LOW))
        for a in range(len(d)):
            for b in range(len(w)):
                if d[a] == w[b] and (a == 0 or b == 0 or d[a - 1] != w[b - 1]):
                    n = 0
                    while a + n < len(d) and b + n < len(w) and d[a + n] == w[b + n]:
                        n += 1
                    if n >= min(width, len(w)):
                        out.append((i, b, a, n))
    return out


def test_equal_hashes_are_no_match(spark, monkeypatch):
    """With a hash that only knows the length of words, the bytes decide."""
    real = decontaminate.word_hashes

    def weak(low, offsets, is_word):
        hashes, counts = real(low, offsets, is_word)
        words = [w for i in range(len(counts)) for w in re.findall(rb"[0-9a-z\x80-\xff]+", low[offsets[i]:offsets[i + 1]].tobytes())]
        return np.array([len(w) for w in words], np.uint64), counts

    monkeypatch.setattr(decontaminate, "word_hashes", weak)
    tests = decontaminate.Tests([1, 2], ["aa bb cc", "dd ee"], 3)
    texts = ["xx aa bb cc yy", "aa bb zz", "dd ee ee dd"]
    low = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    words, counts = weak(low, offsets, decontaminate.ALNUM)
    found = decontaminate.match_shard(words, counts, tests)
    firsts = np.cumsum(counts) - counts
    kept = decontaminate._verbatim(found, tests, {i: t.encode() for i, t in enumerate(texts)}, firsts)
    assert found.shape[1] > kept.shape[1] and sorted(map(tuple, kept.T.tolist())) == [(0, 0, 0, 1, 3), (2, 1, 0, 8, 2)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_matches(spark, edge_docs, block_bytes):
    docs = edge_docs.dropDuplicates(["doc_id"])
    base = dict(texts(docs))
    w = base[8].split(" ")
    items = [(1, " ".join(w[30:60])), (2, "ONE"), (3, None), (4, "own text number 3"), (5, " ".join(w[50:75]).upper()), (6, "!!"),
             (7, "wörter ähnlich")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], sum(s["words"] for s in r["spans"]), sorted(r["items"]))
           for r in decontaminate.find_matches(docs, bench, block_bytes=block_bytes).collect()}
    want = brute_matches(texts(docs), items, 10)
    assert got == want
    for r in decontaminate.find_matches(docs, bench, block_bytes=block_bytes).collect():
        assert sorted(map(tuple, r["matches"]), key=str) == sorted(longest_matches(base[r["doc_id"]], items, 10), key=str)
    kept = {r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()}
    assert kept == {d for d, v in want.items() if not v[1]}


@pytest.mark.parametrize("block_bytes", [1 << 20, 12])
def test_matches_keep_repeated_rows(spark, block_bytes):
    rows = [(1, "a b c"), (1, "a b c"), (1, "x y"), (None, "a b c"), (None, "a b c"), (2, None), (2, None)]
    bench = spark.createDataFrame([(7, "b c"), (8, "a b"), (9, "p q r"), (9, "p q r"), (10, "c")], "item_id long, text string")
    got = decontaminate.find_matches(spark.createDataFrame(rows, "doc_id long, text string"), bench, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "text_hash", "n_words", "spans", "items", "matches"]
    found = collections.Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["spans"])), tuple(sorted(r["items"]))) for r in got.collect())
    assert found == {(1, 3, ((0, 3),), (7, 8, 10)): 2, (1, 2, (), ()): 1, (None, 3, ((0, 3),), (7, 8, 10)): 2, (2, 0, (), ()): 2}


@pytest.mark.parametrize("block_bytes", [1 << 20, 12])
def test_matches_of_items_without_an_id(spark, block_bytes):
    docs = spark.createDataFrame([(1, "a b c"), (2, "x y"), (3, "p q"), (4, "m n p q")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "b c"), (None, "x y"), (5, "a b"), (None, "a b"), (-6, "m n")], "item_id long, text string")
    got = {r["doc_id"]: (sum(s["words"] for s in r["spans"]), r["items"])
           for r in decontaminate.find_matches(docs, bench, block_bytes=block_bytes).collect()}
    assert got == {1: (3, [5, None]), 2: (2, [None]), 3: (0, []), 4: (2, [-6])}
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()] == [3]


def brute_substrings(rows, w):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - w + 1):
            first[b[i:i + w]] = min(d, first.get(b[i:i + w], d))
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        m = bytearray(len(b))
        for i in range(len(b) - w + 1):
            if first[b[i:i + w]] < d:
                m[i:i + w] = b"\1" * w
        out[d] = (len(b), sum(m), sum(m[i] and (i == 0 or not m[i - 1]) for i in range(len(b))), sha(bytes(x for x, k in zip(b, m) if not k)))
    return out


def test_substrings(edge_docs):
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.dedup_substrings(edge_docs).collect()}
    assert got == brute_substrings(texts(edge_docs), 50)


def test_substrings_of_a_hot_anchor_are_dealt(spark, monkeypatch):
    """Texts that share a phrase and differ around it: right, and no bucket has most strings."""
    import random
    rng = random.Random(7)
    own = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60))
    rows = [(i, own() + " one phrase that all of them have, of more than 50 bytes " + own()) for i in range(300)]
    rows += [(400 + i, own()[:30] + "A PHRASE SHORTER THAN THE STRINGS" + own()[:30]) for i in range(300)]
    rows += [(700 + i, rows[i * 11][1][5:]) for i in range(40)] + [(None, rows[3][1])]
    staged = {}

    def keep(spark, df, name, stage=suffix_dedup.stage):
        staged[name] = stage(spark, df, name)
        return staged[name]
    monkeypatch.setattr(suffix_dedup, "stage", keep)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.dedup_substrings(docs, hot=50).collect()}
    last = suffix_dedup.LAST_ID
    want = brute_substrings([(last if d is None else d, t) for d, t in rows], 50)
    assert {last if d is None else d: v for d, v in got.items()} == want
    per = collections.Counter()
    for r in staged["minima"].select(F.explode("minima").alias("m")).select("m.*").collect():
        per[r["bucket"]] += len(suffix_dedup._unpack(r["minima"], "int64"))
    assert max(per.values()) < 0.2 * sum(per.values()), per


def test_merge_sort_orders_suffixes():
    import numpy as np
    data = np.random.default_rng(1).integers(97, 99, 600).astype(np.uint8)
    s = suffix_dedup.Suffixes(data, np.arange(500), 50)
    order = suffix_dedup.merge_sort(s, np.array([0, 300]), np.array([300, 200]))
    raw = data.tobytes()
    for lo, hi in ((0, 300), (300, 500)):
        assert [raw[i:i + 50] for i in order[lo:hi]] == sorted(raw[i:i + 50] for i in range(lo, hi))


def test_near_duplicates(spark, edge_docs):
    base = [f"t{i * 31 % 211}" for i in range(150)]
    rows = [(1000 + i, " ".join(base[:i % 7 * 3 + 100] + [f"u{i}"] + base[120:])) for i in range(60)]
    docs = edge_docs.select("doc_id", "text").dropDuplicates().unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    all_rows = texts(docs)
    sets = {}
    for d, t in all_rows:
        w = WORD.findall((t or "").translate(LOW))
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    near = lambda a, b: a and b and len(a & b) >= 0.8 * len(a | b)
    ids = sorted(sets)
    links = {d: {e for e in ids if e != d and near(sets[d], sets[e])} for d in ids}
    want = {}
    for d in ids:
        seen, todo = {d}, [d]
        while todo:
            for e in links[todo.pop()] - seen:
                seen.add(e)
                todo.append(e)
        want[d] = (min(seen), len(links[d]))
    for small, block in ((800, 1536), (8, 16)):
        got = {r[0]: (r[1], r[2]) for r in jaccard_join.near_duplicates(docs, small=small, block=block).collect()}
        assert got == want


def test_near_duplicates_repeated_rows(spark):
    base = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(base), " ".join(base[1:]), "something else with several words in it"
    rows = [(5, a, "x"), (5, a, "x"), (5, c, "x"), (7, b, "x"), (None, b, "y"), (None, "only here and nowhere else at all", "y"), (None, a, None), (9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((str(r["doc_id"]), r["n_links"], r["leads"]) for r in jaccard_join.near_duplicates(docs).collect())
    assert got == sorted([("5", 4, True), ("5", 4, True), ("5", 0, True), ("7", 4, False), ("None", 4, False), ("None", 0, True),
                          ("None", 4, False), ("9", 0, True)])
    import corpus_pipeline as p
    kept = p.drop_near_duplicates(spark, docs, "")
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == sorted(
        [(5, a), (5, c), (-1, "only here and nowhere else at all"), (9, "")])
    mixed = collections.Counter((r["doc_id"], r["text"]) for r in p.mix_sources(spark, kept, "").collect())
    assert mixed and max(mixed.values()) <= 2


def test_join_hot_equals_a_join(spark):
    rows = spark.createDataFrame([(k, i) for k, n in (("a", 50), ("b", 3), (None, 2), ("c", 1)) for i in range(n)], "k string, i int")
    sizes = spark.createDataFrame([("a", 50), ("b", 3), ("d", 1)], "k string, n int")
    for how in ("inner", "left"):
        for share in (1, 10, 1000):
            got = common.join_hot(rows, sizes, "k", F.col("n"), how, share).collect()
            assert sorted(map(str, got)) == sorted(map(str, rows.join(sizes, "k", how).collect()))


def test_language_and_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = language.held_out(F.col("doc_id"))
    names, protos = language.learn(docs.where(~held))
    got = language.identify(docs.where(held), names, protos)
    assert got.where("lang_pred = lang").count() >= 0.97 * got.count()
    model = quality_classifier.learn(docs, labels.where(~held))
    judged = quality_classifier.score(docs.where(held), model).join(labels, "doc_id").where("quality is not null")
    right = judged.where("(score >= 0.7) = (quality = 1)").count()
    assert right >= 0.9 * judged.count()


def test_models_edge_cases(spark, edge_docs, no_docs):
    names, protos = language.learn(edge_docs)
    got = {r["doc_id"]: r for r in language.identify(edge_docs, names, protos).collect()}
    assert names == ["de", "en"] and all(got[d]["lang_pred"] == "und" and got[d]["score"] == 0 for d in (4, 5, 6))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language.learn(no_docs)
    assert {r["lang_pred"] for r in language.identify(edge_docs, *nothing).collect()} == {"und"}
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (999, 0, 0)], "doc_id long, quality int, toxic int")
    scores = quality_classifier.score(edge_docs, quality_classifier.learn(edge_docs, labels)).collect()
    assert len(scores) == 25 and all(0 <= r["score"] <= 1 for r in scores)


def test_empty_tables(spark, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for df in (mixing.mix(no_docs), quality_rules.judge(no_docs), decontaminate.find_matches(no_docs, bench), chat.format_chats(turns),
               sharding.shard_documents(no_docs), suffix_dedup.dedup_substrings(no_docs), line_dedup.dedup_lines(no_docs),
               jaccard_join.near_duplicates(no_docs), decontaminate.decontaminate(no_docs, bench)):
        assert df.count() == 0


def test_pipeline_stages(spark, edge_docs):
    import corpus_pipeline as p
    d = "/root/testdata/sf0.001"
    kept = p.keep_languages(spark, edge_docs, d)
    assert kept.columns == edge_docs.columns and {r.doc_id for r in kept.collect()} == set(range(1, 32)) - {4, 5, 6, 13, 14, 15, 16, 17, 18, 19}
    single = p.drop_near_duplicates(spark, kept, d)
    assert {2, 3, 10}.isdisjoint(r.doc_id for r in single.collect()) and single.columns == edge_docs.columns
    mixed = p.mix_sources(spark, single, d)
    assert mixed.columns == edge_docs.columns
    assert p.shard(spark, mixed, d).count() == mixed.count()


def test_pipeline_keeps_wanted_languages(spark, edge_docs):
    import corpus_pipeline as p
    names, prototypes = language.learn(edge_docs)
    pred = {(r.doc_id, r.lang_pred) for r in language.identify(edge_docs, names, prototypes).collect()}
    kept = {r.doc_id for r in p.keep_languages(spark, edge_docs, "", wanted=["de"]).collect()}
    assert kept == {d for d, lang in pred if lang == "de"} and kept and kept < {d for d, lang in pred if lang != "und"}
    assert p.keep_languages(spark, edge_docs.limit(0), "").count() == 0


def test_pipeline_run_on_a_table(spark, tmp_path):
    """Every stage one after the other; an empty corpus and one with a contaminated document."""
    import corpus_pipeline as p
    passage = " ".join(f"secret{i}" for i in range(14))
    rows = [(i, f"an ordinary text about the {i} rivers and the {i * 7} hills of its land, once more told", "en", "a", 10) for i in range(30)]
    rows += [(100, "before it " + passage + " after it", "en", "b", 10), (101, None, None, None, 0), (102, "12 34", "en", "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame([(1, passage), (None, "x y")], "item_id long, text string")
    for name, table in (("some", docs), ("none", docs.limit(0))):
        folder = tmp_path / name
        table.write.parquet(str(folder / "documents.parquet"))
        bench.write.parquet(str(folder / "benchmark.parquet"))
        got = p.run(spark, str(folder)).collect()
        assert {r["doc_id"] for r in got} <= set(range(30)) and (len(got) > 20 or name == "none") and (got or name == "none")


def test_pipeline_keeps_texts_without_any_label(spark, edge_docs):
    import corpus_pipeline as p
    docs = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    kept = p.keep_languages(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, t in texts(docs) if d not in (4, 5, 6))
