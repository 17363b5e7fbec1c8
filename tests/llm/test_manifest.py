import zlib
from hashlib import sha256

import pytest

from faremill.llm import manifest, queries
from faremill.llm.manifest import Manifest
from tests.llm.conftest import frame, messy_rows, prose

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(values):
    out = b""
    for v in values:
        raw = None if v is None else str(v).encode()
        out += b"-" if raw is None else str(len(raw)).encode() + b":" + raw
    return sha256(out).hexdigest()


def climb(nodes, at, proof):
    """Root of a list, with the siblings of one node gathered on the way."""
    while len(nodes) > 1:
        run = nodes[at - at % 2 : at - at % 2 + 2]
        proof += [(x, i < at % 2) for i, x in enumerate(run) if i != at % 2] or [None]
        nodes = [sha256("".join(nodes[i : i + 2]).encode()).hexdigest() for i in range(0, len(nodes), 2)]
        at //= 2
    return nodes[0]


def brute(rows, tamper=True):
    """Expected result rows of documents (dicts), one tree at a time."""
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append((row, digest(row[f] for f in FIELDS)))
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for lang in order:
        by_lang[lang].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
    subroots = [climb([leaf for _, leaf in by_lang[lang]], 0, []) for lang in order]
    out = []
    for k, lang in enumerate(order):
        for i, (row, leaf) in enumerate(by_lang[lang]):
            proof = []
            climb([x for _, x in by_lang[lang]], i, proof)
            root = climb(subroots, k, proof)
            shown = dict(row)
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            if tamper and hit and row["n_chars"] is not None:
                shown["n_chars"] += 1
            node = digest(shown[f] for f in FIELDS)
            for step in proof:
                other, left = step or ("", False)
                node = sha256(((other + node) if left else (node + other)).encode()).hexdigest()
            siblings = "".join(step[0] for step in proof if step)
            out.append(
                (row["doc_id"], leaf, subroots[k], root, sha256(siblings.encode()).hexdigest(), node, node == root)
            )
    return sorted(out, key=str)


def found(docs, plan=Manifest()):
    rows = manifest.with_digest(manifest.manifest(docs, manifest.tampered(docs), plan)).drop("height")
    return sorted(map(tuple, rows.collect()), key=str)


def dicts(docs):
    return [r.asDict() for r in docs.select(*FIELDS).collect()]


@pytest.mark.parametrize("levels", [1, 2, 3, 12])
def test_messy_rows_in_any_superblocks(messy, levels):
    expected = brute(dicts(messy))
    assert found(messy, Manifest(levels=levels)) == expected
    assert len({r[6] for r in expected}) == 2


def test_sizes_of_lists(spark):
    """Lists of every small length, around powers of two, null fields among them."""
    rows = []
    for lang in range(1, 20):
        for i in range(lang):
            rows.append((lang * 100 + i, prose(i, 3), f"l{lang}" if lang != 5 else None))
    docs = frame(spark, rows).selectExpr(
        "doc_id", "text", "lang", "IF(doc_id % 3 = 0, null, source) AS source",
        "IF(doc_id % 4 = 0, null, n_chars) AS n_chars",
    )
    assert found(docs, Manifest(levels=2)) == brute(dicts(docs))


@pytest.mark.parametrize("count", [1, 2])
def test_few_rows(spark, count):
    docs = frame(spark, [(i, "one text", "en") for i in range(count)])
    expected = brute(dicts(docs))
    assert found(docs) == expected
    if count == 1:
        assert expected[0][1] == expected[0][2] == expected[0][3]


def test_one_language_and_one_id_hold_everything(spark):
    """Rows that are all equal are dealt out like any others."""
    docs = frame(spark, [(7, "same", "en")] * 200 + [(i, prose(i), "en") for i in range(300)]).repartition(7)
    assert found(docs, Manifest(levels=3)) == brute(dicts(docs))


def test_untampered_rows_verify_and_proofs_fold(messy):
    rows = manifest.manifest(messy).collect()
    assert rows and all(r.verified and r.folded_root == r.root for r in rows)
    for r in rows:
        assert manifest.fold(r.leaf, r.siblings, r.sides) == r.root
        assert len(r.siblings) == 64 * len(r.sides.replace("-", ""))


def test_every_changed_field_is_noticed(messy):
    from pyspark.sql import functions as F

    for name in ("text", "source", "lang"):
        shown = {name: F.concat(F.coalesce(F.col(name), F.lit("")), F.lit("x"))}
        assert not any(r.verified for r in manifest.manifest(messy, shown).collect())


def test_no_rows(nothing):
    assert manifest.manifest(nothing, manifest.tampered(nothing)).count() == 0


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = queries.QUERIES["op12_subtree_exchange"](spark, small).drop("height").collect()
    assert sorted(map(tuple, rows), key=str) == brute(dicts(docs))
