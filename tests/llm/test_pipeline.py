"""Each stage of the pipeline against a plain Python version over its own input, and the run as a whole."""

import numpy as np
import pytest
import regex

import corpus_pipeline
from skyloom.llm import common
from skyloom.llm import op3_toxicity as o3
from skyloom.llm import op6_language as o6
from tests.llm.test_similarity import roots, shingle_sets
from tests.llm.test_text import KINDS, counts, plain_bootstrapping
from tests.llm.test_tokens import check_packing, ids_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage but the last leaves: (name, rows before, rows after)."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.materialize(stage(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_toxic_documents_go(spark, steps):
    before, after = steps["toxicity"]
    model = o3.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    weights = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))

    def score(text):
        words = set(regex.findall(r"\w+", (text or "").lower()))
        z = model.bias + sum(weights.get(k, 0.0) for k in {k for w in words for k in o3.features_of_word(w)})
        return 1 / (1 + np.exp(-z))

    assert ids(after) == sorted(r.doc_id for r in before.collect() if score(r.text) < 0.3)
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    gone = set(ids(before)) - set(ids(after))
    assert gone and len(gone & toxic) >= 0.5 * len(toxic & set(ids(before)))


def test_unknown_languages_go(spark, steps):
    before, after = steps["language"]
    model, kept = o6.fit(before), []
    for r in before.collect():
        text = (r.text or "").lower()
        if not any(c.isalpha() for c in text):
            continue
        n = {}
        for size in (1, 2, 3):
            shown = [ord(c) if c.isalpha() else 32 for c in text]
            for k in range(len(shown) - size + 1):
                a, b, c = (shown[k : k + size] + [0, 0])[:3]
                h = a * 2654435761 % 2**32
                if size > 1:
                    h = (h ^ (b * 2246822519 % 2**32)) * 3266489917 % 2**32
                if size > 2:
                    h = (h ^ (c * 668265263 % 2**32)) * 374761393 % 2**32
                n[h >> 18] = n.get(h >> 18, 0) + 1
        x = {f: (1 + np.log(v)) * model.idf[f] for f, v in n.items()}
        size = np.sqrt(sum(v * v for v in x.values()))
        z = (sum(v / size * model.weights[f].astype(float) for f, v in x.items()) + model.bias) / model.temperature
        if 1 / np.exp(z - z.max()).sum() >= 0.5:
            kept.append(r.doc_id)
    assert ids(after) == sorted(kept)


def test_one_of_each_group_stays(steps):
    before, after = steps["near_duplicates"]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    sets, holders = [shingle_sets(r.text) for r in rows], {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    pairs = {(a, b) for ks in holders.values() for a in ks for b in ks if b < a}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert ids(after) == [r.doc_id for k, (r, root) in enumerate(zip(rows, roots(len(rows), links), strict=True)) if k == root] and links


def test_personal_data_is_replaced(steps):
    before, after = steps["personal_data"]
    texts = {r.doc_id: r.text for r in before.collect()}
    added = plain_bootstrapping({k: t or "" for k, t in texts.items()})
    changed = 0
    for r in after.collect():
        text = texts[r.doc_id]
        spans = [(m.start(), -m.end(), k) for k, p in KINDS.items() for m in regex.finditer(p, text or "") if counts(k, m[0])]
        spans += [(int(a), -int(e), k) for k, a, e in (x.split(":") for x in added[r.doc_id])]
        parts, at = [], 0
        for a, e, k in sorted(spans):
            if a >= at:
                parts += [text[at:a], f"[{k.upper()}]"]
            at = max(at, -e)
        want = None if text is None else "".join(parts) + text[at:]
        assert r.text == want
        changed += want != text
    assert changed


def test_all_that_stays_is_packed(spark, steps):
    docs = steps["personal_data"][1]
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    n, total = check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, 1024)
    assert n <= -(-total // 1024) + 8


def test_run_is_its_stages_and_leaves_no_tables(spark, steps):
    import os

    folder = common.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r.text for r in steps["personal_data"][1].collect()}
    assert sorted({r.doc_id for r in rows}) == sorted(docs)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert left <= {"stage-personal_data", "pieces", "packed"}, left


def test_packed_sequences_are_the_corpus(spark, sf_dir):
    rows = corpus_pipeline.packed_sequences(spark, sf_dir).collect()
    kept = corpus_pipeline.kept(spark, sf_dir).collect()
    assert sum(len(r.ids) // 4 for r in rows) == sum(len(ids_of(r.text)) + 1 for r in kept) and max(r.n for r in rows) <= 1024
