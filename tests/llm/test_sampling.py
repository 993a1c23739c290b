"""Fill-in-middle, importance resampling and repeated strings against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import documents, lower
from textgauge.llm import fill_middle, importance, suffix_repeats
from textgauge.llm.queries import QUERIES

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def written(spark, tmp_path, **tables):
    """A folder of tables, as queries take one."""
    for name, df in tables.items():
        df.coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def plain_fim(doc_id, text):
    text = text or ""
    units = TOKEN.findall(text)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), form, len(p), len(m), sha(out), sha(text)


def fim_texts():
    rnd = random.Random(1)
    alphabet = ["a", "bc", "é", "漢字", "😀", " ", "\n", "\t \x0b", "\x1c", " ", "word"]
    texts = [None, "", " ", "\n\n \t", "x", " x", "x ", "a <M> b c", "<P>", "<S", "P> <"]
    texts += ["".join(rnd.choices(alphabet, k=rnd.randint(1, 80))) for _ in range(150)]
    # boundaries that no single line comes near: long words, then short ones
    return texts + [" ".join(["w" * 3000] * 40 + ["y"] * 5000 + ["z" * 900] * 50), "q" * 200_000, " " * 100_000 + "é"]


def test_fill_middle_query(spark, tmp_path):
    texts = fim_texts()
    ids = [None, *range(1, len(texts))]
    docs = documents(spark, texts + [texts[20]], ids + [20])
    found = QUERIES["op12_fill_middle"](spark, written(spark, tmp_path, documents=docs)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((plain_fim(*r) for r in zip(ids + [20], texts + [texts[20]])), key=repr)
    assert {r.form for r in found} == {"plain", "spm", "psm"}


def test_empty_tables(spark, tmp_path):
    none = documents(spark, [])
    folder = written(spark, tmp_path, documents=none, benchmark=spark.createDataFrame([], "item_id long, text string"))
    for name in ("op11_suffix_repeats", "op12_fill_middle", "op13_importance"):
        assert QUERIES[name](spark, folder).collect() == []


def test_rank_index_is_exact_and_bounded():
    rnd = np.random.default_rng(3)
    texts = [np.cumsum(rnd.integers(1, hi, size)) for hi, size in ((2, 50), (9, 4000), (5000, 3000), (3, 1), (2, 0))]
    texts.append(np.concatenate([np.arange(1, 2000), 10**6 + 700 * np.arange(2000)]))
    offsets = np.concatenate([np.concatenate([[0], t]) for t in texts]).astype(np.int64)
    firsts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    index = fill_middle.RankIndex(offsets, firsts)
    assert (index.offset(np.arange(len(offsets))) == offsets).all()
    assert np.abs(index.residuals.astype(int)).max() <= fill_middle.ERROR
    # even text is one segment, and lines are far fewer than boundaries
    assert len(index.starts) < len(offsets) / 4 and (np.searchsorted(index.starts, firsts[1]) == 1)


def test_crc_by_position():
    rnd = random.Random(1)
    data = rnd.randbytes(300_000)
    starts = np.array([rnd.randrange(200_000) for _ in range(2000)])
    ends = starts + np.array([rnd.choice([0, 1, 5, 63, 64, 65, 127, 128, 129, 1000, 70_000]) for _ in range(2000)])
    found = importance.crc32(np.frombuffer(data, np.uint8), starts, ends)
    assert [int(x) for x in found] == [zlib.crc32(data[a:b]) for a, b in zip(starts, ends)]


def buckets_of(text):
    words = WORD.findall(lower(text or ""))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in runs]


def plain_resampling(rows, items):
    ours = [(i, *buckets_of(t)) for i, t in rows]
    s, t = Counter(b for *_, bs in ours for b in bs), Counter(b for x in items for b in buckets_of(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in s}
    out = []
    for i, n_words, bs in ours:
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(sha(f"7:{'' if i is None else i}")[:8], 16)
        out.append([i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for place, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = place
    return [tuple(r[:5]) for r in out]


def resampling_rows():
    rnd = random.Random(5)
    pool = ["Alpha", "béta", "x1", "漢", "delta", "EPS", "of", "the"]
    texts = [None, "", " ... ", "one"] + [" ".join(rnd.choices(pool, k=rnd.randint(1, 60))) + rnd.choice(["", "!", " -- "]) for _ in range(200)]
    return list(zip([None, *range(1, len(texts))], texts)), ["alpha béta of the", None, "", "delta-eps; x1 of"]


def test_importance_query(spark, tmp_path):
    rows, items = resampling_rows()
    folder = written(
        spark, tmp_path, documents=documents(spark, [t for _, t in rows], [i for i, _ in rows]), benchmark=spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    )
    found = QUERIES["op13_importance"](spark, folder).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain_resampling(rows, items), key=repr)


def test_importance_of_repeated_rows(spark):
    """Copies of one id, a third of the table, share a score; together they take as many ranks."""
    rows, items = resampling_rows()
    rows += [(50, rows[50][1] + " of the" * 20)] * 100
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(6)
    found = importance.resample(docs, spark.createDataFrame([(x,) for x in items], "text string")).collect()
    expected = plain_resampling(rows, items)
    assert sorted((r.id, r.score) for r in found if r.id is not None) == sorted((r[0], r[3]) for r in expected if r[0] is not None)
    assert sorted(r.rank for r in found if r.rank) == sorted(r[4] for r in expected if r[4])
    assert sorted((r.id or 0, r.rank) for r in found if r.rank and r.id != 50) == sorted((r[0] or 0, r[4]) for r in expected if r[4] and r[0] != 50)


@pytest.mark.parametrize("piece", [16, 100])
def test_long_texts_are_cut_between_words(monkeypatch, piece):
    monkeypatch.setattr(importance, "PIECE", piece)
    rnd = random.Random(2)
    texts = [" ".join("w" * rnd.randint(1, 40) + rnd.choice("abc") for _ in range(50)) + "  ,, " * rnd.randint(0, 30) + "end" for _ in range(20)] + ["y" * 500, " " * 300, ""]
    found, words = [[] for _ in texts], [0] * len(texts)
    for rows, pieces, carried in importance._chunks(texts):
        bucket, owner, n = importance.features(pieces, carried)
        for b, o in zip(bucket, owner):
            found[rows[o]].append(int(b))
        for row, k in zip(rows, n):
            words[row] += int(k)
    assert [(n, sorted(b)) for n, b in zip(words, found)] == [(n, sorted(b)) for n, b in map(buckets_of, texts)]


def plain_removal(texts, length):
    """(kept, removed runs) of each text; every start of a repeated string counts."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def passages(seed, length):
    """Texts with shared passages, copies, near copies, runs of one letter, and one passage in many surroundings."""
    rnd = random.Random(seed)
    fresh = lambda n: "".join(rnd.choices("abcdefgh é漢 ", k=n))
    shared = [fresh(rnd.randint(length - 2, 3 * length)) for _ in range(4)]
    texts = [None, "", "a", "z" * (length - 1), "z" * length, "y" * (4 * length), "xy" * (2 * length)]
    texts += [fresh(rnd.randint(1, 4 * length)) for _ in range(10)]
    texts += [texts[12]] * 3 + [texts[13][:-1] + "Q", "é" + texts[14]]
    texts += [fresh(rnd.randint(0, length)) + rnd.choice(shared) + fresh(rnd.randint(0, length)) for _ in range(20)]
    return texts + [fresh(rnd.randint(0, 2 * length)) + shared[0] + fresh(rnd.randint(0, 2 * length)) for _ in range(20)]


@pytest.mark.parametrize("length,gram,group,spread", [(20, 6, 8192, 64), (20, 6, 8192, 1), (20, 6, 3, 1), (8, 3, 2, 2), (200, 32, 8192, 64), (200, 32, 4, 1)])
def test_repeats_against_brute_force(spark, length, gram, group, spread):
    """Also with so few surroundings allowed that windows become pieces of their own."""
    texts = passages(length + group, length)
    docs = documents(spark, texts, [None, *range(1, len(texts))]).repartition(5)
    found = suffix_repeats.remove_repeats(docs, length=length, gram=gram, group=group, spread=spread)
    assert found.columns == ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()}
    assert [got[i] for i in [None, *range(1, len(texts))]] == plain_removal(texts, length)


def test_repeats_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "BROADCAST_ROWS", 0)
    texts = passages(9, 20)
    found = suffix_repeats.remove_repeats(documents(spark, texts).repartition(5), length=20, gram=6, group=2)
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts, 20)


def test_repeats_query_with_equal_rows_and_a_long_text(spark, tmp_path):
    rnd = random.Random(8)
    long = "".join(rnd.choices("abcdefghij ", k=600_000))
    texts = [long, long[:300], long[299_900:300_300], "own text " + "".join(rnd.choices("klm", k=500)), "k" * 400, "short"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (5, "short")]
    folder = written(spark, tmp_path, documents=documents(spark, [t for _, t in rows], [i for i, _ in rows]))
    found = [tuple(r) for r in QUERIES["op11_suffix_repeats"](spark, folder).collect()]
    expected = [(i, n, gone, runs, sha(kept)) for (i, _), (n, gone, runs, kept) in zip(rows, plain_removal([t for _, t in rows], 200))]
    assert sorted(found) == sorted(expected)


def test_expansion_against_brute_force():
    rnd = random.Random(2)
    for _ in range(200):
        length, letters = rnd.choice([2, 3, 5, 8]), rnd.choice([b"a", b"ab", b"abc\xff\x00"])
        strings = list({bytes(rnd.choices(letters, k=rnd.randint(length, 30))) for _ in range(rnd.randint(1, 12))})
        weights = [rnd.choice([1, 1, 1, 2]) for _ in strings]
        found, heads = suffix_repeats.repeated_windows(strings, weights, length)
        seen = Counter()
        for s, w in zip(strings, weights):
            for i in range(len(s) - length + 1):
                seen[s[i : i + length]] += w
        for s, head in zip(strings, heads):
            assert [bool(found[head + i]) for i in range(len(s) + 1)] == [i <= len(s) - length and seen[s[i : i + length]] > 1 for i in range(len(s) + 1)]
