"""SimHash, its index and near copies against plain Python."""

import random

import numpy as np
import xxhash

from tests.llm.helpers import DOCS, Groups, documents, lower, split
from textgauge.llm import components as components_module
from textgauge.llm import near_copies, simhash
from textgauge.llm.components import components


def plain_fingerprint(text, size=3):
    w = split(lower(text or ""))
    shingles = [" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(rnd, code, bits):
    for b in rnd.sample(range(64), bits):
        code ^= 1 << b
    return code


def test_gray_rank_is_the_inverse_of_the_gray_code():
    ranks = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(ranks ^ ranks >> np.uint64(1)) == ranks).all()


def test_index_finds_every_group():
    for seed in range(6):
        rnd = random.Random(seed)
        centres = [rnd.getrandbits(64) for _ in range(15)]
        codes = sorted({near(rnd, rnd.choice(centres), rnd.randint(0, 6)) for _ in range(700)} | {0, 2**64 - 1})
        rnd.shuffle(codes)
        split_of = np.array([c % 3 for c in codes])
        got = simhash.GrayIndex(split_of, np.array(codes, np.uint64)).links(3)
        groups = Groups(range(len(codes)))
        for i in range(len(codes)):
            for j in range(i):
                if split_of[i] == split_of[j] and (codes[i] ^ codes[j]).bit_count() <= 3:
                    groups.join(i, j)
        mine = Groups(range(len(codes)))
        for i, j in enumerate(got):
            mine.join(i, int(j))
        assert [mine.find(i) for i in range(len(codes))] == [groups.find(i) for i in range(len(codes))]


def test_links_with_splits_of_splits(spark):
    """All fingerprints share 44 bits, so every split is split again, as far as it goes."""
    rnd = random.Random(9)
    codes = sorted({rnd.getrandbits(20) << 20 | 5 for _ in range(600)} | {near(rnd, 77, 2) for _ in range(50)})
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), max_split=8).collect()
    mine, groups = Groups(codes), Groups(codes)
    for a, b in edges:
        assert ((a ^ b) & (2**64 - 1)).bit_count() >= 1
        mine.join(a % 2**64, b % 2**64)
    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= 3:
                groups.join(a, b)
    assert {c: mine.find(c) for c in codes} == {c: groups.find(c) for c in codes}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101 + k) for k in range(50)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 151)} | {201: 200}


def test_near_duplicates_against_plain_python(spark):
    rnd = random.Random(2)
    base = [" ".join(rnd.choice(["alpha", "beta", "É", "Gamma", "delta"]) for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    texts = [None, "", " \n", "one", "one two", "ONE two"] + base + base[:15] + [b + " tail" for b in base[:20]]
    ids = [None, *range(100, 99 + len(texts))]
    docs = documents(spark, texts + [texts[9]], ids + [ids[9]])
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 1
    prints = [plain_fingerprint(t) for t in texts]
    groups = Groups(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                groups.join(i, j)
    first = {}
    for k in range(len(texts)):
        if ids[k] is not None:
            first.setdefault(groups.find(k), ids[k])
    want = {ids[k]: (prints[k], first[groups.find(k)]) for k in range(len(texts))}
    assert {r["id"]: (r["fp"] % 2**64, r["component_id"]) for r in rows} == want
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_near_copies_by_shingles(spark):
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    text = lambda n: [rnd.choice(words) for _ in range(n)]
    passage = text(60)

    def edited(w, changes):
        w = list(w)
        for k in rnd.sample(range(len(w)), changes):
            w[k] = "changed%d" % rnd.randrange(10**6)
        return w

    origins = [text(300) for _ in range(8)]
    texts = {k: o for k, o in enumerate(origins)}
    for k, o in enumerate(origins):
        texts[20 + k] = edited(o, 3)
        texts[40 + k] = list(o)
        texts[60 + k] = edited(o, 100)  # no copy any more
        texts[80 + k] = text(120) + passage + text(120)
    docs = documents(spark, [" ".join(w) for w in texts.values()] + [None, "", " "], [*texts, 900, 901, None])
    rows = near_copies.near_copies(docs).collect()
    by = {r["rk"]: r["id"] for r in rows}
    first = {r["id"]: by[r["first"]] for r in rows}
    for k in range(8):
        assert first[k] == first[20 + k] == first[40 + k] == k
        assert first[60 + k] == 60 + k and first[80 + k] == 80 + k
    assert first[900] == first[901] == first[None] == 900
    assert near_copies.near_copies(spark.createDataFrame([], DOCS)).count() == 0


def test_near_copies_that_are_far_from_the_first_of_their_class(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    texts, pairs = {}, []
    for k in range(0, 300, 3):
        body = [word() for _ in range(80)]
        changed = [*body[:-2], word(), body[-1]]
        texts |= {k: body + [word() for _ in range(30)], k + 1: body, k + 2: changed}
        pairs.append((k, k + 1, k + 2))
    docs = documents(spark, [" ".join(w) for w in texts.values()], [*texts])
    rows = near_copies.near_copies(docs).collect()
    by = {r["rk"]: r["id"] for r in rows}
    first = {r["id"]: by[r["first"]] for r in rows}
    assert [(first[a], first[b], first[c]) for a, b, c in pairs] == [(a, b, b) for a, b, _ in pairs]


def test_near_copies_against_all_pairs(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    texts = [[rnd.choice(words) for _ in range(rnd.randint(5, 60))] for _ in range(60)]
    for _ in range(240):
        w = list(rnd.choice(texts))
        for _ in range(rnd.randint(1, 3)):
            k = rnd.randrange(len(w) + 1)
            w[k : k + rnd.randint(0, 1)] = [rnd.choice(words)] * rnd.randint(0, 2)
        texts.append(w)
    texts = [" ".join(w) for w in texts]
    groups, sets = Groups(range(len(texts))), [near_copies.shingle_set(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if near_copies.jaccard(sets[i], sets[j]) >= 0.8:
                groups.join(i, j)
    rows = near_copies.near_copies(documents(spark, texts, [*range(len(texts))])).collect()
    by = {r["rk"]: r["id"] for r in rows}
    first: dict = {}
    for k in range(len(texts)):
        first.setdefault(groups.find(k), k)
    assert {r["id"]: by[r["first"]] for r in rows} == {k: first[groups.find(k)] for k in range(len(texts))}


def test_near_copies_with_long_boilerplate_or_one_frequent_word(spark):
    rnd = random.Random(10)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    shared = [word() for _ in range(820)]
    often = next(w for w in iter(word, None) if xxhash.xxh64_intdigest(w.encode()) % near_copies.PASSAGE_WORDS == 0)

    def edited(w, changes):
        w = list(w)
        for k in range(changes):
            w[3 + k * len(w) // changes] = word()
        return w

    texts = {}
    for k in range(30):
        body = [word() for _ in range(180)]
        texts |= {k: shared + body, 100 + k: shared + edited(body, 8)}
        words = [word() if n % 4 else often for n in range(400)]
        texts |= {200 + k: words, 300 + k: edited(words, 8)}
    rows = near_copies.near_copies(documents(spark, [" ".join(w) for w in texts.values()], [*texts])).collect()
    by = {r["rk"]: r["id"] for r in rows}
    assert {r["id"]: by[r["first"]] for r in rows} == {k: k - 100 if k // 100 % 2 else k for k in texts}
    assert near_copies.passages([w.encode() for w in texts[200]])


def test_parities_differ_in_no_more_bits_than_shingles():
    rng = np.random.default_rng(3)
    for shared, own in ((0, 40), (100, 9), (300, 0), (500, 200)):
        both = rng.integers(0, 2**63, shared).astype(np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 2**63, own).astype(np.uint64)]) for _ in range(2))
        differing = np.unpackbits(np.frombuffer(near_copies.parities(a), np.uint8) ^ np.frombuffer(near_copies.parities(b), np.uint8)).sum()
        assert differing <= 2 * own and (differing > 0) == (own > 0)


def test_near_copies_of_one_text_make_few_pairs(monkeypatch, spark):
    """160 texts with one word changed at one of eight places: alike if at the same one, 0.70 similar if not."""
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join([*words[: 7 * (i % 8) + 2], f"x{i}", *words[7 * (i % 8) + 3 :]]) for i in range(160)]
    pairs, kept = [], near_copies._checked
    monkeypatch.setattr(near_copies, "_checked", lambda found, *a: pairs.append(found.count()) or kept(found, *a))
    rows = near_copies.near_copies(documents(spark, texts, [*range(160)])).collect()
    keys = {r["rk"]: r["id"] for r in rows}
    assert {r["id"]: keys[r["first"]] for r in rows} == {i: i % 8 for i in range(160)}
    assert max(pairs) < 160 * 15


def test_a_task_of_near_copies_has_one_python_worker(monkeypatch, spark):
    plans, kept = [], components_module.saved
    for module in (near_copies, simhash, components_module):
        monkeypatch.setattr(module, "saved", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan()) or kept(df))
    rnd = random.Random(14)
    text = [rnd.choice("abcdefgh") * rnd.randint(1, 9) + str(k) for k in range(80)]
    near_copies.near_copies(documents(spark, [" ".join(text), " ".join([*text[:-1], "other"]), "a b c"])).collect()
    python = 0
    while plans:
        node, above = plans.pop(), False
        while True:  # down what one task runs without a shuffle
            name, below = node.nodeName(), [node.children().apply(k) for k in range(node.children().size())]
            assert not (above and name == "MapInArrow")
            above = name == "MapInArrow" or above and name in ("Project", "Filter", "CollectMetrics")
            python += name == "MapInArrow"
            plans += below[1:]
            if not below:
                break
            node = below[0]
    assert python >= 4


def test_shingles_go_only_to_pairs_that_sketches_allow(monkeypatch, spark):
    rng = np.random.default_rng(5)
    for n in (0, 1, 30, 31, 400, 3000):
        whole = np.unique(rng.integers(0, 1 << 32, 2 * n + 8, dtype=np.uint32))
        for a, b in ((whole[:n], whole[n // 9 : n + n // 9]), (whole[: n // 2], whole[:n]), (whole[:n], whole[n : 2 * n])):
            x, y = (s.astype("<u4").tobytes() for s in (a, b))
            assert near_copies.may_be_similar(near_copies.sketch(x), near_copies.sketch(y), 0.8) >= (near_copies.jaccard(x, y) >= 0.8)
    assert not near_copies.may_be_similar(near_copies.sketch(x), near_copies.sketch(y), 0.8)
    texts = [" ".join(f"{w}{k}" for k in range(200)) for w in "abcdefgh"]
    docs = documents(spark, [*texts, texts[0] + " end"], [*range(9)])
    keys = [r["rk"] for r in docs.select(near_copies.row_key("doc_id", "text").alias("rk")).orderBy("doc_id").collect()]
    pairs = spark.createDataFrame([(keys[i], keys[j]) for i in range(9) for j in range(i)], "a long, b long")
    seen, kept = [], near_copies._compared
    monkeypatch.setattr(near_copies, "_compared", lambda found, *a: seen.append(found.count()) or kept(found, *a))
    assert {frozenset(r) for r in near_copies._checked(pairs, docs, "doc_id", "text", 0.8).collect()} == {frozenset((keys[0], keys[8]))}
    assert seen == [36, 1]
