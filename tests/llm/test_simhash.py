import hashlib
import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest

pytest.importorskip("tesselon.llm")

from tesselon.llm import simhash  # noqa: E402

SCHEMA = "doc_id long, text string, fingerprint string"


def text(r, n):
    return " ".join(f"w{r.randrange(3000)}" for _ in range(n))


M = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M
    return x ^ x >> 31


def word_hash(w):
    h = mix(len(w) + 0x9E3779B97F4A7C15 & M)
    if len(w) > 64:
        return mix(int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little"))
    for k in range(0, len(w), 8):
        h = mix(h ^ int.from_bytes(w[k : k + 8], "little")) + 0xD1342543DE82EF95 & M
    return mix(h)


def run_hash(hashes):
    total = len(hashes)
    for i, h in enumerate(hashes):
        odd = 0x9E3779B97F4A7C15 * (2 * i + 3) & M | 1
        total += mix(h ^ odd) * odd
    return mix(total & M)


def plain(text):
    """The fingerprint by the rules alone, in whole numbers."""
    words = [word_hash(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    terms = Counter(words) + Counter(run_hash(p) for p in zip(words, words[1:]))
    out = []
    for lane in range(4):
        salt = mix((lane + 1) * 0xA0761D6478BD642F & M)
        votes = [0] * 64
        for t, c in terms.items():
            h, weight = mix(t ^ salt), round(16 * (1 + math.log(c)))
            for k in range(64):
                votes[k] += weight if h >> k & 1 else -weight
        # the bits of a lane from its lowest byte on, the highest bit of each byte first
        out += [sum((votes[8 * b + 7 - k] > 0) << 7 - k for k in range(8)) for b in range(8)]
    return bytes(out).hex()


def test_fingerprints_by_the_rules(spark):
    r = random.Random(2)
    texts = ["", " \n", "one", "one one one", "a b", "é🙂 x\u00a0y \t z", "x" * 64, "x" * 65, "x" * 1000 + " y", *(text(r, n) for n in (3, 10, 60, 400))]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    got = {x["doc_id"]: x["fingerprint"] for x in simhash.fingerprint_documents(df).collect()}
    assert [got[i] for i in range(len(texts))] == [plain(t) for t in texts]


def test_query_finds_near_documents(spark):
    r = random.Random(6)
    base = text(r, 900)
    texts = [base, base, base + " end", text(r, 900), None, text(r, 5), None]
    out = simhash.with_near(simhash.compare_neighbours(spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], SCHEMA)))
    assert out.columns[:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    fp = [int(plain(t or ""), 16) for t in texts]
    near = {i: [j for j in range(7) if j != i and bin(fp[i] ^ fp[j]).count("1") <= simhash.RADIUS] for i in range(7)}
    assert near[0] == [1, 2] and {x["doc_id"]: x["n_near"] for x in out.collect()} == {i: len(n) for i, n in near.items()}


def test_neighbours(spark):
    r = random.Random(4)
    rows = [(i * 7 % 401 + (10**12 if i % 5 == 0 else 0), text(r, r.choice([0, 1, 3, 40, 300])) + "é🙂") for i in range(120)] + [(-3, None), (10**13, "z " * 100_000)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    out = {x["doc_id"]: x for x in simhash.compare_neighbours(df).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(out) == len(rows)
    fp = {i: bytes.fromhex(plain(t)) if len(t) < 10_000 else simhash.fingerprints([t])[0].tobytes() for i, t in order}
    for (i, t), (j, x) in zip(order, [*order[1:], order[0]]):
        made = t[: len(t) - len(t) // 3] + x[: len(t) // 3]
        changed = simhash.fingerprints([made])[0].tobytes()
        assert (out[i]["n_chars"], out[i]["edited_sha256"]) == (len(t), hashlib.sha256(made.encode()).hexdigest())
        assert (out[i]["fingerprint"], out[i]["edited_fingerprint"]) == (fp[i].hex(), changed.hex())
        bits = lambda a, b: 1 - bin(int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).count("1") / 256
        assert abs(out[i]["near_edited"] - bits(fp[i], changed)) < 1e-12 and abs(out[i]["near_next"] - bits(fp[i], fp[j])) < 1e-12
    big = [x for x in out.values() if 1000 < x["n_chars"] < 5000]
    assert min(x["near_edited"] for x in big) > max(x["near_next"] for x in big)


def test_one_row_and_none_and_repeats(spark):
    one = simhash.compare_neighbours(spark.createDataFrame([(1, "a b c d e f", "")], SCHEMA)).collect()
    assert [(x["near_next"], x["n_chars"]) for x in one] == [(1.0, 11)]
    assert simhash.compare_neighbours(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "b", ""), (1, "a", ""), (1, "a", ""), (None, "n", ""), (None, None, "")]
    assert len(simhash.compare_neighbours(spark.createDataFrame(rows, SCHEMA)).collect()) == 5


@pytest.mark.parametrize("agree", [None, 1, 2, 3])
def test_search_finds_all_within_the_radius(spark, agree):
    r = random.Random(9)
    fps = []
    for _ in range(40):
        base = r.getrandbits(64)
        fps += [base ^ sum(1 << b for b in r.sample(range(64), r.randrange(6))) for _ in range(6)] + [base] * 2
    rows = [(i, f"{x:016x}") for i, x in enumerate(fps)]
    df = spark.createDataFrame([*rows, (9000, None), (None, rows[0][1])], "doc_id long, fingerprint string")
    out = {x["doc_id"]: (x["component_id"], x["n_links"]) for x in simhash.near_fingerprints(df, 3, agree=agree, block_docs=3).collect()}
    comp, links = {i: i for i, _ in rows}, dict.fromkeys(range(len(rows)), 0)

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in combinations(range(len(fps)), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= 3:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            comp[y] = x
    assert {i: (find(i), links[i]) for i, _ in rows} == {i: v for i, v in out.items() if i is not None and i < 9000}
    assert out[9000] == (9000, 0) and out[None] == (None, 0)


def test_tables_hold_every_pair_within_the_radius():
    import numpy as np

    r = random.Random(1)
    for bits, radius, agree in ((64, 3, 1), (64, 5, 2), (256, 8, 2), (256, 20, 2)):
        a = [r.getrandbits(bits) for _ in range(200)]
        b = [x ^ sum(1 << k for k in r.sample(range(bits), radius)) for x in a]
        x, y = (simhash.table_keys(np.frombuffer(b"".join(v.to_bytes(bits // 8, "big") for v in c), np.uint8).reshape(200, -1), radius, agree) for c in (a, b))
        assert (x == y).any(1).all()
    assert simhash.agreeing(10, 8, 256) == 1 and simhash.agreeing(10**10, 8, 256) == 2


def test_search_of_no_rows(spark):
    assert simhash.near_fingerprints(spark.createDataFrame([], "doc_id long, fingerprint string"), 3).collect() == []
