"""Every operator on odd rows, and on no rows at all: a row per document, defined results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from midyear.llm import bytenet, langid, lm
from midyear.llm.decontamination import contaminated_spans
from midyear.llm.hasharrays import in_32_bits
from midyear.llm.lines import without_near_lines
from midyear.llm.mixing import mix_sources
from midyear.llm.quality import quality_rules
from midyear.llm.rollup import TokenRollup, word_counter
from midyear.llm.simhash import fingerprint, first_of_each, near_duplicates
from midyear.llm.substrings import without_repeats
from midyear.sources.shared import fresh_path


def _bench(docs):
    return docs.sparkSession.createDataFrame(
        [(1, "a dozen words to be read here and more of them follow"), (2, None), (3, ""), (None, "x"), (1, "x")],
        "item_id bigint, text string")


def _labels(docs):
    return docs.sparkSession.createDataFrame(
        [(4, 1), (9, 0), (9, 0), (8, None), (None, 1), (7, 1)], "doc_id bigint, quality int")


def _score_lm(docs):
    return lm.score(docs, lm.fit(docs))


def _rollup(docs):
    rollup = TokenRollup(docs.sparkSession, fresh_path(docs.sparkSession, "rollup"), {"words-1": word_counter})
    rollup.commit("one", docs.select(F.lit("insert").alias("kind"), "doc_id", "text", "source", "lang"))
    return rollup.totals()


OPERATORS = {
    "simhash": near_duplicates,
    "lm": _score_lm,
    "langid": lambda docs: langid.predict(docs, langid.fit(docs)),
    "quality": quality_rules,
    "mixing": mix_sources,
    "decontamination": lambda docs: contaminated_spans(docs, _bench(docs)),
    "bytenet": lambda docs: bytenet.score(docs, bytenet.fit(docs, _labels(docs))),
    "substrings": without_repeats,
    "lines": without_near_lines,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_document(odd, name):
    rows = OPERATORS[name](odd).collect()
    assert len(rows) == 12
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", [*OPERATORS, "rollup"])
def test_no_documents(odd, name):
    none = odd.limit(0)
    assert (_rollup if name == "rollup" else OPERATORS[name])(none).collect() == []


def test_results_for_odd_rows(odd):
    by = {}
    for name, operator in OPERATORS.items():
        by[name] = {r.doc_id: r for r in operator(odd).collect() if r.doc_id is not None}
    assert [by["simhash"][i].fingerprint for i in (1, 2, 3)] == ["0" * 16] * 3
    assert {by["simhash"][i].component_id for i in (1, 2, 3)} == {1}
    assert by["simhash"][5].component_id == by["simhash"][4].component_id == 4
    assert [by["lm"][i].n_tokens for i in (1, 2, 3, 7)] == [1, 1, 1, 2]
    assert [by["langid"][i].lang_pred for i in (1, 2, 3, 9)] == ["und"] * 4
    assert by["langid"][9].score == 0.0
    assert not any(by["quality"][i].kept for i in (1, 2, 3, 7, 9)) and by["quality"][4].kept
    assert [by["mixing"][i].taken for i in (1, 2, 3)] == [0, 0, 0]
    assert by["decontamination"][7].n_hit == 1 and by["decontamination"][7]["items"] == ["", "1"]
    assert by["decontamination"][1].n_words == 0
    assert all(0 <= by["bytenet"][i].score <= 1 for i in range(1, 10))
    assert by["substrings"][6].n_words == 60_000
    assert by["lines"][5].n_removed == 1 and by["lines"][4].n_removed == 0
    totals = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in _rollup(odd).collect()}
    assert totals["src1", None] == (1, 60_000) and totals[None, None][0] == 2


def test_stages_keep_all_columns(odd, spark, tmp_path):
    _bench(odd).write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (odd, odd.limit(0)):
            out = stage(spark, table, str(tmp_path))
            assert out.dtypes == table.dtypes, name
            out.collect()
    mixed = corpus_pipeline.STAGES[-1][1](spark, odd, str(tmp_path)).collect()
    assert all(0 < r.taken <= 2 * r.size for r in mixed)
    assert corpus_pipeline.STAGES[-1][1](spark, odd.limit(0), str(tmp_path)).collect() == []


def test_one_of_each_component_stays(odd):
    kept = first_of_each(odd).select("doc_id").collect()
    # the documents without words are one component; the repeated rows leave one
    assert sorted(str(r.doc_id) for r in kept) == sorted(map(str, [1, None, 4, 6, 7, 8, 9]))


def test_an_id_in_several_components_costs_no_document(documents):
    a, b = ("alpha beta gamma delta epsilon zeta eta theta iota kappa", "one two three four five six seven eight nine ten")
    kept = first_of_each(documents([(1, a), (2, a), (1, b), (3, b)])).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == sorted([(1, a), (1, b)])


def test_near_duplicates_without_ids_are_one_group(documents):
    words = [f"w{i}" for i in range(400)]
    near, base = None, np.uint64(fingerprint(" ".join(words).encode()) & (2**64 - 1))
    for i in range(400):
        text = " ".join([*words[:i], "other", *words[i + 1 :]])
        if 1 <= np.bitwise_count(base ^ np.uint64(fingerprint(text.encode()) & (2**64 - 1))) <= 2:
            near = text
    assert near
    assert first_of_each(documents([(None, " ".join(words)), (None, near)])).count() == 1
    both = first_of_each(documents([(None, " ".join(words)), (7, near), (None, "quite another text")])).collect()
    assert sorted(str(r.doc_id) for r in both) == ["7", "None"]


def test_mixed_documents_keep_their_columns(odd, spark):
    mixed = corpus_pipeline.STAGES[-1][1](spark, odd, "")
    assert set(odd.columns) <= set(mixed.columns) and dict(mixed.dtypes)["taken"] == "bigint"
    assert {r.text for r in mixed.collect()} <= {r.text for r in odd.collect()}


def test_repeated_rows_do_not_reach_the_driver_each(documents, monkeypatch):
    same = documents([(None, f"all the same words here {i % 3}", "en") for i in range(600)]
                     + [(i, f"autres mots que ceux de la {i}", "fr") for i in range(40)])
    seen = []
    monkeypatch.setattr(langid, "Hierarchy", lambda x, langs: seen.append(langs))
    langid.fit(same, sample=200)
    assert seen[0].count("en") <= 3 and seen[0].count("fr") == 40
    labels = documents([(7, "x")]).sparkSession.createDataFrame([(7, 1), (8, 0)], "doc_id bigint, quality int")
    monkeypatch.setattr(bytenet, "train", lambda chunks, marks: seen.append(chunks))
    bytenet.fit(documents([(7, f"copy {i}") for i in range(300)] + [(8, "bad")]), labels, per_class=5)
    assert seen[1] == [b"copy 0", b"bad"]


def test_large_counts_fail_instead_of_wrapping():
    assert in_32_bits(np.array([2**32 - 1])).tolist() == [2**32 - 1] and len(in_32_bits(np.zeros(0, np.int64))) == 0
    with pytest.raises(OverflowError):
        in_32_bits(np.array([1, 2**32 + 9]))
