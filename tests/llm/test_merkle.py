"""The Merkle manifest against a tree built in plain Python, and its log against appending leaf by leaf."""

import hashlib
import zlib

import pytest

from labtide.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, rank int, tree string, item string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc, text, lang, source, n_chars):
    out = ""
    for value in (doc, source, lang, n_chars, text):
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return h(out)


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def path_of(levels, place):
    """(index within its run, others of the run) for each level below the top."""
    out = []
    for level in levels[:-1]:
        run = level[place // 2 * 2 : place // 2 * 2 + 2]
        out.append((place % 2, run[: place % 2] + run[place % 2 + 1 :]))
        place //= 2
    return out


def brute(docs):
    runs = {}
    for doc in docs:
        runs.setdefault(doc[2], []).append(doc)
    langs = sorted(runs, key=lambda x: (x is not None, (x or "").encode()))
    trees, out = [], []
    for lang in langs:
        runs[lang].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(*d)))
        trees.append(levels_of([leaf_of(*d) for d in runs[lang]]))
    top = levels_of([t[-1][0] for t in trees])
    for t, lang in enumerate(langs):
        for place, doc in enumerate(runs[lang]):
            path = path_of(trees[t], place) + path_of(top, t)
            tampered = doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 7 == 0 and doc[4] is not None
            node = leaf_of(*doc[:4], doc[4] + 1) if tampered else leaf_of(*doc)
            for mine, others in path:
                node = h(*others[:mine], node, *others[mine:])
            root = top[-1][0]
            proof = h(*[s for _, others in path for s in others])
            out.append((doc[0], leaf_of(*doc), trees[t][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "t", "i") for d in docs], SCHEMA)


DOCS = [
    *[(i * 3 - 40, f"text é {i}", "en", f"s{i % 4}", i) for i in range(45)],
    *[(i, "x" * i, "de", None, None if i % 5 == 0 else 2**63 - 1 - i % 2) for i in range(17)],
    *[(i, None, None, "s", i) for i in range(3)],
    (7, "", "Ünder", "s", 0),
    (8, "one", "", "s", 3),
    (9, "y" * 300_000, "fr", "s", 300_000),
    (9, "z", "fr", "s", 1),
    (9, "z", "fr", "s", 1),
    (None, "w", "fr", "s", 1),
    (None, None, "fr", None, None),
]


@pytest.mark.parametrize("bits", [1, 2, 3, 9])
def test_op11_equals_brute_force(spark, bits):
    got = merkle.verified(frame(spark, DOCS), bits)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(DOCS)


@pytest.mark.parametrize("docs", [[], DOCS[:1], DOCS[:2], DOCS[45:46] + DOCS[:1], [DOCS[0]] * 40])
def test_op11_small_trees_and_repeats(spark, docs):
    assert sorted(map(tuple, merkle.verified(frame(spark, docs), 2).collect()), key=str) == brute(docs)


def test_op11_ranges_cut_a_language(spark, monkeypatch):
    from labtide.llm import ranks

    plain = ranks.ranked
    monkeypatch.setattr(merkle, "ranked", lambda rows, key, order: plain(rows, key, order, run=7))
    assert sorted(map(tuple, merkle.verified(frame(spark, DOCS), 2).collect()), key=str) == brute(DOCS)


def test_positions_are_those_of_an_append_log():
    """Leaves are appended one by one; a node is written when its subtree is complete, the ragged ones at the end."""
    for n in range(1, 70):
        log, counts = [], [0] * (merkle.height(n) + 1)

        def write(level):
            log.append((level, counts[level]))
            counts[level] += 1
            if level < merkle.height(n) and counts[level] % 2 == 0:
                write(level + 1)

        for _ in range(n):
            write(0)
        for level in range(merkle.height(n)):
            if counts[level] % 2:
                write(level + 1)
        assert [merkle.position(level, index, n) for level, index in log] == [*range(len(log))]


def test_op11_proof_finds_any_change(spark):
    rows = merkle.proofs(frame(spark, DOCS), bits=3).collect()
    for row in rows:
        assert merkle._folded(row.leaf, row.sides, row.proof) == row.root
        assert merkle._folded(h(row.leaf), row.sides, row.proof) != row.root
