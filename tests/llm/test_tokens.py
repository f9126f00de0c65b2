"""Token counts and token alignment against the tokenizers themselves."""

import collections
import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sectionmap.llm import token_alignment, token_counts
from sectionmap.llm.byte_level import SPLIT, byte_chars, newer_letters, read_vocabulary, splitter, token_bytes
from sectionmap.llm.queries import tokenizer_file

NASTY = ["", None, " ", "\n\n \t x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endoftext", "don't I'LL we've 's", "1234567 12,5",
         "naïve Straße 東京都 مرحبا 🙂🙂 é", "x" * 5000, "ab" * 3000 + " " * 70 + "c", "▁ a▁b", "a    b　", "\x00\x1c\x1f\x85",
         " lead", "trail  ", "<s>[INST] </s><unk><0x0A>", "tab\tnew\r\nline", "ﬁ ½ Ⅷ", "▁", "  two  spaces  "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def texts(edge_docs):
    rng = random.Random(3)
    words = ["the", "of", "Wörter", "land", "survey", "'s", "x1", "…", "--", "\n", "  "]
    more = [" ".join(rng.choice(words) + rng.choice(words) for _ in range(rng.randrange(1, 200))) for _ in range(60)]
    return [*NASTY, *more, *(r["text"] for r in edge_docs.collect())]


@pytest.fixture(scope="module")
def token_docs(spark, texts):
    rows = [(i if i % 17 else None, t, 1, "x", 2, 3, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, groups string, n_a int, pairs int, n_bytes string")


def test_pieces_are_the_library_s_for_every_code_point(library):
    raw = tokenizer_file("byte_bpe_50k.json")
    newer = newer_letters()
    find, odd = regex.compile(SPLIT).findall, regex.compile(f"[{newer}]")
    chars = {b: c for c, b in byte_chars().items()}
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    mixed = f"é{newer[0]}1 {newer[-1]}"
    assert splitter(raw, newer)(mixed) == [mixed[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(mixed)]
    points = [c for c in points if not odd.match(chr(c))]
    assert len(points) > 1_000_000
    for first in range(0, len(points), 4096):
        text = "".join(f"a{chr(c)}b {chr(c)}1{chr(c)} " for c in points[first:first + 4096])
        want = [p for p, _ in library.pre_tokenizer.pre_tokenize_str(text)]
        assert ["".join(chars[b] for b in p.encode()) for p in find(text)] == want


def test_parts_keep_the_pieces():
    find = regex.compile(SPLIT).findall
    for text in filter(None, NASTY):
        for most in (1, 3, 10, 1000):
            cut = list(token_counts.parts(text, most))
            assert "".join(cut) == text and [p for c in cut for p in find(c)] == find(text)


def test_vocabulary_reader_refuses_other_kinds():
    with pytest.raises(ValueError):
        read_vocabulary(tokenizer_file("word_bpe_49k.json"))


def test_token_counts(token_docs, texts, library):
    got = token_counts.count_tokens(token_docs, tokenizer_file("byte_bpe_50k.json"), keep=("doc_id", "groups"), limit=40)
    assert got.columns == ["doc_id", "groups", "n_bytes", "n_tokens", "over_limit"]
    count = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    want = [(i if i % 17 else None, "x", len((t or "").encode()), n, n > 40) for i, (t, n) in enumerate(zip(texts, count))]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)


def test_a_word_of_a_megabyte(library):
    vocabulary = read_vocabulary(tokenizer_file("byte_bpe_50k.json"))
    counts = token_counts.PieceCounts(*vocabulary[:3])
    word = "".join(random.Random(5).choice("etaoin") for _ in range(1 << 20))
    assert counts[word] == len(library.encode(word, add_special_tokens=False).ids) and not counts


def test_kept_pieces_are_bounded(monkeypatch, library):
    monkeypatch.setattr(token_counts, "KEPT_PIECES", 5)
    counts = token_counts.PieceCounts(*read_vocabulary(tokenizer_file("byte_bpe_50k.json"))[:3])
    for w in (f"word{i}" for i in range(40)):
        assert counts[w] == len(library.encode(w, add_special_tokens=False).ids) and len(counts) <= 5


def brute_alignment(texts):
    a_file = tokenizer_file("byte_bpe_50k.json")
    a_of, a_bytes = Tokenizer.from_str(a_file.decode()), token_bytes(a_file)
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def b_bytes(i):
        piece = b_of.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if regex.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    rows = []
    for t in texts:
        a, b = (a_of.encode(" " + t, add_special_tokens=False).ids, b_of.encode(t)) if t else ([], [])
        whole = (" " + (t or "")).encode()
        if not t or b"".join(a_bytes[i] for i in a) != whole or b"".join(map(b_bytes, b)) != whole:
            rows.append(([], [], [], []))
            continue
        a_ends = list(itertools.accumulate(len(a_bytes[i]) for i in a))
        b_ends = list(itertools.accumulate(len(b_bytes(i)) for i in b))
        links = [(x, y) for x, e in zip(a, a_ends) for y in [dict(zip(b_ends, b)).get(e)] if y is not None] if len(a) < 3000 else [
            (x, y) for m in [dict(zip(b_ends, b))] for x, e in zip(a, a_ends) for y in [m.get(e)] if y is not None]
        cuts = [0, *sorted(set(a_ends) & set(b_ends))]
        groups = [",".join(str(x) for x, e in zip(a, a_ends) if lo < e <= hi) + "|" + ",".join(str(y) for y, e in zip(b, b_ends) if lo < e <= hi)
                  for lo, hi in zip(cuts, cuts[1:])] if len(a) < 3000 else None
        rows.append((a, b, groups, links))
    count = collections.Counter(p for r in rows for p in r[3])
    top = collections.Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return [(len(a), len(b), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links), ";".join(g) if g is not None else None)
            for a, b, g, links in rows]


@pytest.mark.parametrize("hot_pairs,digest", [(1 << 17, True), (10, False)])
def test_alignment(token_docs, texts, hot_pairs, digest):
    aligned = token_alignment.align(token_docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"), digest=digest)
    got = token_alignment.score(aligned, token_alignment.link_counts(aligned), hot_pairs=hot_pairs).collect()
    assert len(got) == len(texts) and all(r["n_groups"] == r["n_links"] for r in got)
    want = brute_alignment(texts)
    seen = collections.Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_links"], r["n_best"], r["count_sum"]) for r in got)
    assert seen == collections.Counter((i if i % 17 else None, *w[:5]) for i, w in enumerate(want))
    groups = {r["doc_id"]: r["groups"] for r in got}
    for i, w in enumerate(want):
        if i % 17 and w[5] is not None:
            assert groups[i] == (w[5] if not digest or not w[0] else hashlib.sha256(w[5].encode()).hexdigest())
    assert any(w[0] == 0 and t for w, t in zip(want, texts)) and any(w[0] > 3000 for w in want)


def test_windows_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_alignment, "KEPT_WINDOWS", 3)
    w = token_alignment.Windows([1, 2, 3], [3, 1, 2])
    link = lambda a, b: a << token_alignment.ID_BITS | b
    cases = [([0, 1], [0], "0,1|0", [(1, 0)]), ([2], [1, 2], "2|1,2", [(2, 2)]), ([0, 0], [1, 1], "0|1;0|1", [(0, 1)] * 2),
             ([0, 1, 0], [0, 1], "0,1|0;0|1", [(1, 0), (0, 1)])]
    a, b = (np.array(sum((c[k] for c in cases), []), np.int32) for k in (0, 1))
    firsts = [np.cumsum([0, *(len(c[k]) for c in cases)]) for k in (0, 1)]
    keys = token_alignment.packed(a, b, *firsts)
    assert [np.frombuffer(k, np.int32).tolist() for k in keys] == [[*c[0], -1, *c[1]] for c in cases]
    for _ in range(3):
        places = [w[k] for k in keys]
        assert [w.texts[i] for i in places] == [c[2] for c in cases]
        assert w.links(np.array(places)).tolist() == [link(*p) for c in cases for p in c[3]]
        w.trim()
        assert not w and len(w.old) == 4
    w.trim()
    assert len(w.old) == 4 and [w[k] for k in keys[:1]] == [0]


def test_texts_are_cut_like_their_windows(library, texts):
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    encoders = token_alignment.Encoders(*files)
    windows = token_alignment.Windows(encoders.a_sizes, encoders.b_sizes)
    several = 0
    for ids in filter(None, encoders.encode([t or "" for t in texts])):
        a, b = ids
        firsts = token_alignment.window_starts(*(np.cumsum(s[i]) for s, i in ((encoders.a_size, a), (encoders.b_size, b))), encoders.a_mark[a], encoders.b_mark[b])
        places = [windows[k] for k in token_alignment.packed(a, b, *firsts)]
        a_last, b_last = token_alignment.group_ends(a, b, encoders)
        assert (a[a_last].astype(np.int64) << token_alignment.ID_BITS | b[b_last]).tolist() == windows.links(np.array(places)).tolist()
        assert token_alignment.group_text(a, b, a_last, b_last, encoders).decode() == ";".join(windows.texts[p] for p in places)
        several += len(a_last) > len(places)
    assert several


def test_both_libraries_split_alike(library):
    quick = token_alignment._ranked(tokenizer_file("byte_bpe_50k.json"))
    plain = Tokenizer.from_str(tokenizer_file("byte_bpe_50k.json").decode())
    plain.encode_special_tokens = True
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for first in range(0, len(points), 4096):
        text = "".join(f"a{chr(c)}b {chr(c)}1{chr(c)}! {chr(c)}!{chr(c)} " for c in points[first:first + 4096])
        assert quick.encode_ordinary(text) == plain.encode(text, add_special_tokens=False).ids
    for text in filter(None, NASTY):
        assert quick.encode_ordinary(" " + text) == plain.encode(" " + text, add_special_tokens=False).ids


def test_no_rows(spark, no_docs):
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    assert token_counts.count_tokens(no_docs, files[0]).count() == 0
    aligned = token_alignment.align(no_docs, *files)
    assert token_alignment.score(aligned, token_alignment.link_counts(aligned)).count() == 0
    only_null = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    aligned = token_alignment.align(only_null, *files)
    got = token_alignment.score(aligned, token_alignment.link_counts(aligned))
    assert sorted(map(tuple, got.select("n_a", "n_best", "count_sum", "groups").collect())) == [(0, 0, 0, "")] * 2
    assert got.where(F.col("doc_id").isNull()).count() == 1
