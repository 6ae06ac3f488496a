"""The pipeline on the smallest data folder, each stage against brute force on its own input."""

import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from brute_force import components, covered, near, shingles
from tokenizers import Tokenizer

import corpus_pipeline
from martlane.llm import registry, tokens

ROOT = Path(__file__).resolve().parent.parent.parent
DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no driver data")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents, and what each stage made of its predecessor's."""
    found = [spark.read.parquet(str(DATA / "documents.parquet"))]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, found[-1], str(DATA)).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def test_all_but_the_last_return_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "repeated_substrings", "mix_sources", "pack",
    ]
    for frame in stages[1:-1]:
        assert frame.columns == stages[0].columns


def test_quality_rejects_what_labels_call_bad(spark, stages):
    labels = spark.read.parquet(str(DATA / "labels.parquet")).collect()
    kept = {r.doc_id for r in stages[1].collect()}
    right = sum((r.doc_id in kept) == (r.quality == 1) for r in labels)
    assert right >= 0.9 * len(labels)


def test_one_of_each_group_stays(stages):
    sets = {r.doc_id: shingles(r.text, 5) for r in stages[1].collect()}
    roots = components(sets, near(sets, 80))
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(roots.values()))


def test_repeated_strings_go(stages):
    texts = {r.doc_id: (r.text or "").encode() for r in stages[2].collect()}
    gone = covered(texts)
    left = {r.doc_id: r for r in stages[3].collect()}
    assert set(left) == set(texts)
    for i, r in left.items():
        kept = bytes(np.frombuffer(texts[i], np.uint8)[~gone[i]])
        assert r.text == kept.decode("utf-8", "ignore")
        assert r.n_chars == len(r.text)


def test_the_mix_takes_rows_up_to_twice(stages):
    before = {(r.doc_id, r.text): 0 for r in stages[3].collect()}
    for r in stages[4].collect():
        before[r.doc_id, r.text] += 1
    assert set(before.values()) <= {0, 1, 2}
    words = lambda text: len((text or "").encode().split())
    total = sum(words(t) for _, t in before)
    taken = sum(n * words(t) for (_, t), n in before.items())
    assert abs(taken - 1.5 * total) < 0.1 * total


def test_sequences_hold_the_ids_of_the_mix(stages):
    library = Tokenizer.from_str(tokens.public(tokens.BYTE_BPE))
    want = []
    for r in stages[4].collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((r.doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in stages[5].collect()]
    assert sorted(got) == sorted(want)


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, str(DATA)).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[-1].select(*columns).collect()))


def test_every_operator_has_a_query():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in registry.QUERIES}
    assert numbers == set(range(1, 14))
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


def test_the_rest_works_without_the_subpackage():
    code = (
        "import sys; sys.modules['martlane.llm'] = None; import __spark_entry__ as e;"
        "names = set(e.queries()); print(len(names), any(n.startswith('op1') for n in names),"
        " 'pipeline' in names)"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    n, op, pipeline = run.stdout.split()
    assert (int(n) > 100, op, pipeline) == (True, "False", "False")
