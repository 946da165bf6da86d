import hashlib
import random
import zlib

import pytest

from oddlens.llm.merkle import merkle_proofs, missing

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, part long, digest string"


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(fields):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(digests):
    found = [digests]
    while len(found[-1]) > 1:
        found.append([H("".join(found[-1][k : k + 3])) for k in range(0, len(found[-1]), 3)])
    return found


def siblings(tree, at):
    found = []
    for level in tree[:-1]:
        first = at // 3 * 3
        found.append(("".join(level[first:at]), "".join(level[at + 1 : first + 3])))
        at //= 3
    return found


def brute(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[:5])))
        trees[s] = mine, levels([leaf(r[:5]) for r in mine])
    top = levels([trees[s][1][-1][0] for s in sources])
    found = []
    for k, s in enumerate(sources):
        mine, tree = trees[s]
        for at, r in enumerate(mine):
            proof = siblings(tree, at) + siblings(top, k)
            own = r[:5]
            folded = leaf(own)
            if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 2 == 0 and own[4] is not None:
                folded = leaf((*own[:4], own[4].replace("\n", "")))
            for left, right in proof:
                folded = H(left + folded + right)
            found.append((r[0], leaf(own), tree[-1][0], top[-1][0], H("".join(a + b for a, b in proof)), folded, folded == top[-1][0]))
    return sorted(found, key=str)


def some_rows(n, sources, seed=1):
    rng = random.Random(seed)
    rows = [(k, rng.choice(sources), rng.choice(["de", None]), k, rng.choice(["a\nb", "text", None, "", "ü\n"]) if k % 3 else f"t {k}\n", k, "x") for k in range(n)]
    return rows + [(None, sources[0], None, None, "x\n", 0, ""), (None, sources[0], None, None, "y\n", 0, ""), rows[1], rows[1], (5, sources[0], "de", 5, "other", 1, "")]


@pytest.mark.parametrize("n, sources, size", [(2, ["a"], 8192), (40, ["a", None, "é", "z", "Z"], 7), (700, ["hot"] * 9 + [None, "b", ""], 64), (300, [f"s{k}" for k in range(150)], 16)])
def test_proofs_equal_brute_force(spark, n, sources, size):
    rows = some_rows(n, sources)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, merkle_proofs(df, size, page_levels=2).collect()), key=str) == brute(rows)


def test_full_proofs_fold_to_the_root(spark):
    rows = some_rows(60, ["a", "b", None])
    for r in merkle_proofs(spark.createDataFrame(rows, SCHEMA), 10, full=True).collect():
        assert H("".join(r.proof)) == r.proof_sha256


def test_missing_is_the_smallest_union():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 90)
        own = rng.sample(range(n), rng.randint(1, n))
        tree = levels([H(str(k)) for k in range(n)])
        needed, derived = set(), {(0, at) for at in own}
        for level in range(len(tree) - 1):
            for at in range(len(tree[level])):
                below = at * 3**level
                if any(below <= k < below + 3**level for k in own):
                    derived.add((level, at))
                    first = at // 3 * 3
                    needed |= {(level, x) for x in range(first, min(first + 3, len(tree[level])))}
        assert set(missing(own, n)) == needed - derived
    assert missing([0], 1) == []


def test_no_rows(spark):
    assert merkle_proofs(spark.createDataFrame([], SCHEMA)).collect() == []
