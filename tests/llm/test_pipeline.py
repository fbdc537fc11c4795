"""The pipeline stage by stage, and the registration of its queries."""

import hashlib
import subprocess
import sys

import public_tokenizers as P
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from medialoom.llm import byte_bpe, quality

from .helpers import ODD, corpus, documents
from .helpers import components as plain_components
from .test_near_copies import shingles
from .test_texts import brute_base, brute_lines, brute_scores


def tables(spark, folder, rows, labels):
    documents(spark, rows).select(*corpus_pipeline.COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_against_plain_python(spark, tmp_path):
    rows = corpus(120) + [(500 + i, f"@@@ {i} ### x{i} ### ||| $$$ " * 9, "en", "s2") for i in range(4)] + [(600, None, "en", "s1")]
    folder = tables(spark, str(tmp_path / "t"), rows, [(i, 1, 0) for i in range(80)])
    docs, stages = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(out := str(tmp_path / name))
        docs = spark.read.parquet(out)
        stages.append(docs)
    kept = []
    for r, score in zip(rows, brute_scores([r[:2] for r in rows], set(range(80)), quality.BUCKETS)):
        n, *_, repeated = brute_base(r[1])
        if n >= 10 and 100 * repeated <= 20 * n and score >= quality.THRESHOLD:
            kept.append(r)
    assert sorted(r.doc_id for r in stages[0].collect()) == sorted(r[0] for r in kept)
    assert 40 < len(kept) < len(rows)
    cleaned = brute_lines([r[:2] for r in kept])
    wanted = sorted((r[0], cleaned[r[:2]][0]) for r in kept)
    assert sorted((r.doc_id, r.text) for r in stages[1].collect()) == wanted
    assert all(r.n_chars == len(r.text) for r in stages[1].collect())
    sets = [shingles(t) for _, t in wanted]
    links = [
        (a, b) for a in range(len(wanted)) for b in range(a)
        if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    roots = sorted({wanted[r][0] for r in plain_components(len(wanted), links)})
    assert sorted(r.doc_id for r in stages[2].collect()) == roots
    assert {r.doc_id for r in stages[3].collect()} <= set(roots)
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(wanted)
    assert stages[4].count() == stages[3].count()
    for r in stages[4].collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == stages[4].columns
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, stages[4].collect()))


def test_pipeline_of_odd_and_of_no_documents(spark, tmp_path):
    odd = tables(spark, str(tmp_path / "odd"), ODD, [(5, 1, 0), (None, None, None)])
    assert corpus_pipeline.run(spark, odd).count() > 0
    empty = tables(spark, str(tmp_path / "empty"), [], [])
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13


def test_the_rest_of_the_library_does_not_import_these():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e;"
        "assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline'];"
        "assert not [m for m in sys.modules if m.startswith('medialoom.llm')]; print(len(e.queries()))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=entry.__file__.rpartition("/")[0], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
