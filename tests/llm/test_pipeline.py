"""The pipeline stage by stage against brute force, and its contract."""

import hashlib
import os

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as cp
from kinship.llm import bpe_codec, toxicity
from tests.llm import test_decontaminate as dc
from tests.llm import test_parity_join as pj

SF = "/root/testdata/sf0.001"
UP = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "toxicity", "th", "kept"]


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest table with odd rows and clashing columns."""
    rows = [(*r, None, "x", 1) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(None, None, None, None, None, 1.0, "y", 2), (None, "", "en", "s", 0, 1.0, "y", 2), (5000, rows[3][1], "en", "s", 1, 0.0, "y", 3),
             (*rows[7][:5], None, "x", 1), (5001, rows[9][1].upper(), "en", "s", 1, 0.0, "y", 3),
             (5002, rows[11][1] + " more", "en", "s", 1, 0.0, "y", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "toxicity double, th string, kept int")


def stage(name):
    return dict(cp.STAGES)[name]


def run(spark, name, d):
    out = stage(name)(spark, d, SF)
    assert out.columns == COLUMNS
    return sorted(map(str, out.collect()))


def test_stages_are_named_in_order():
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None


def test_toxicity(spark, docs):
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    reader, w = toxicity.Reader(model.lexicon), np.array(model.weights)
    ok = [r for r in docs.collect()
          if 1 / (1 + np.exp(-(np.array(reader.features(r.text or "")) @ w + model.bias))) < 0.3]
    assert run(spark, "toxicity", docs) == sorted(map(str, ok))


def test_exact(spark, docs):
    best = {}
    for r in docs.collect():
        k, rank = (r.text or "").translate(UP), -1 if r.doc_id is None else r.doc_id
        if k not in best or rank > best[k][0]:
            best[k] = (rank, str(r))
    got = run(spark, "exact dedup", docs)
    # a null and an empty text without id are equal and equally good
    pick = lambda s: s.replace("text=None, lang=None, source=None, n_chars=None", "text='', lang='en', source='s', n_chars=0")      # noqa: E731
    assert sorted(map(pick, got)) == sorted(pick(s) for _, s in best.values())


def test_near(spark, docs):
    rows = docs.collect()
    sets = [pj.shingles(r.text, 5) for r in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= 80 * len(sets[a] | sets[b]):
                top[root(a)] = root(b)
    first = {}
    for x, r in enumerate(rows):
        if sets[x]:
            rank = (r.doc_id is None, r.doc_id)
            if root(x) not in first or rank < first[root(x)][0]:
                first[root(x)] = (rank, str(r))
    assert run(spark, "n-gram Jaccard join", docs) == sorted(
        [s for _, s in first.values()] + [str(r) for x, r in enumerate(rows) if not sets[x]])


def test_decontamination(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = docs.collect()
    clean = [r for r in rows if not dc.scan([(0, r.text)], items, 10)[0][-1]]
    assert 0 < len(clean) < len(rows)
    assert run(spark, "benchmark decontamination", docs) == sorted(map(str, clean))


def test_encoding(spark, docs):
    ranks = bpe_codec.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exp = []
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text or "")
        exp.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = stage("byte-level BPE")(spark, docs, SF).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, exp))


def test_run_equals_its_stages(spark):
    import __spark_entry__ as E

    d = spark.read.parquet(f"{SF}/documents.parquet")
    n = d.count()
    out = E.queries()["pipeline"](spark, SF)
    assert 0 < out.count() < n
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids))


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, f in cp.STAGES:
        assert f(spark, d, SF).collect() == []


def test_entry_without_the_subpackage(tmp_path):
    """The registry works where the subpackage and the pipeline are gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(cp.__file__))
    shutil.copytree(f"{root}/kinship", tmp_path / "kinship", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(k.startswith('op') for k in q))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    n, *rest = said.stdout.split()
    assert int(n) >= 28 and rest == ["False", "False"], said.stderr
