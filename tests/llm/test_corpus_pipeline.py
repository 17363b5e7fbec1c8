import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from faremill.llm import minhash, quality
from faremill.llm.storage import table, written


def test_stages_one_by_one(spark, small):
    docs = table(spark, small, "documents")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], small), name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frames[-1].columns == columns
    ids = [sorted(r.doc_id for r in f.select("doc_id").collect()) for f in frames[:-1]]
    judged = {r.doc_id for r in quality.judge(frames[0]).collect() if r.kept}
    assert set(ids[1]) == judged
    stay = {r.doc_id for r in minhash.find(frames[1]).collect() if r.kept}
    assert set(ids[2]) == stay and len(ids[2]) == len(stay)
    assert ids[3] == ids[2] and set(ids[4]) <= set(ids[3])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = sorted(tokenizer.encode(r.text, add_special_tokens=False).ids + [1] for r in frames[4].collect())
    pieces = defaultdict(list)
    for p in frames[5].collect():
        pieces[p.doc_id].append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    whole = [[t for _, ids in sorted(v) for t in ids] for v in pieces.values()]
    assert sum(map(len, whole)) == sum(map(len, expected))


def test_run_equals_the_stages(spark, small):
    rows = __spark_entry__.queries()["pipeline"](spark, small)
    assert rows.columns[:3] == ["doc_id", "start", "length"] and rows.count() > 0


def test_the_rest_works_without_this_subpackage(tmp_path):
    """Without the llm folders and corpus_pipeline.py the entry module still imports."""
    root = Path(__file__).resolve().parents[2]
    for name in ("checks", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(root / name)
    (tmp_path / "faremill").mkdir()
    for path in (root / "faremill").iterdir():
        if path.name not in ("llm", "__pycache__"):
            (tmp_path / "faremill" / path.name).symlink_to(path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
