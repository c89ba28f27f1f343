"""The pipeline against a plain version of its stages, and odd rows."""

import re

import corpus_pipeline
import public_tokenizers as P
import pytest
import tiktoken
from brute import BLANK, contamination
from pyspark.sql import functions as F

from rowmill.llm import private, tokens

SF = "/root/testdata/sf0.001"
RANKS = tokens.read_ranks(P.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def firsts(texts):
    """Of each group of near copies the smallest id."""
    sets = {}
    for i, t in texts.items():
        w = BLANK.findall(t or "")
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if both and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return {i for i in sets if label[i] == i}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Some documents and odd rows, with the benchmark of the smallest tables."""
    folder = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    passage = items.orderBy("item_id").first()["text"]
    odd = [
        (1000, None, "en", "s", None), (1001, "", None, None, 0), (1002, "12 34 !!", "en", "s", 8), (1003, f"the {passage} of", "en", "s", 1),
        (1004, "with the and of that jane.doe@mail.example.com +1 (389) 555-5010 in the of", "en", "s", 1), (None, "the of and that", "en", "s", 1),
        (1004, "with the and of that jane.doe@mail.example.com +1 (389) 555-5010 in the of", "en", "s", 1),
    ]
    docs.union(spark.createDataFrame(odd, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_as_plain(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns

    docs = corpus_pipeline.identify_language(spark, docs, small).cache()
    letters = [r for r in rows if re.search(r"[^\W\d_]", r.text or "")]
    assert sorted(map(str, docs.collect())) == sorted(map(str, letters)) and docs.columns == columns

    kept = firsts({r.doc_id: r.text for r in letters if r.doc_id is not None})
    docs = corpus_pipeline.drop_near_copies(spark, docs, small).cache()
    got = docs.collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in got) == sorted([*kept, -1]) and docs.columns == columns

    docs = corpus_pipeline.drop_contaminated(spark, docs, small).cache()
    clean = [r for r, (_, hit, _) in zip(got, contamination([r.text for r in got], items)) if not hit]
    assert sorted(map(str, docs.collect())) == sorted(map(str, clean)) and 1003 not in {r.doc_id for r in clean}

    docs = corpus_pipeline.replace_private(spark, docs, small).cache()
    assert docs.columns == columns and docs.count() == len(clean)
    made = {r.doc_id: r for r in docs.collect()}
    for r in clean:
        new = made[r.doc_id]
        assert len(new.text) == new.n_chars and (new.lang, new.source) == (r.lang, r.source)
        if not re.search(r"[0-9@]", r.text):
            assert new.text == r.text
    assert "jane.doe" not in made[1004].text and "555-5010" not in made[1004].text and made[1004].text.startswith("with the and of that ")

    last = corpus_pipeline.to_tokens(spark, docs, small).collect()
    assert len(last) == len(made)
    for r in last:
        assert r.exact and r.ids == LIBRARY.encode_ordinary(made[r.doc_id].text) and r.n_tokens == len(r.ids)
    assert private.PATTERN


def test_run_and_empty_tables(spark, small, tmp_path):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES][0] == "identify_language" and corpus_pipeline.ORACLE_SQL is None
    whole = corpus_pipeline.run(spark, small)
    assert whole.where("NOT exact").count() == 0 and whole.count() > 60
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_texts_in_no_learned_language_go(spark):
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "xqzv kwpfj zzgh vbnmq wrtzx plkjq hgfdz qwxcv bnmkl zxqjw vkpqz",
    ]
    clean = ["the of and that", "with the and of"]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = [(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(foreign + clean)]
    got = corpus_pipeline.identify_language(spark, docs.union(spark.createDataFrame(planted, docs.schema)), "").select("doc_id", "text").collect()
    ids = {r.doc_id for r in got}
    assert not ids & set(range(10**9, 10**9 + len(foreign))) and set(range(10**9 + len(foreign), 10**9 + len(planted))) <= ids
    letters = docs.where(F.col("text").rlike(r"\p{L}")).count()
    assert letters * 0.99 < len(got) - len(clean) <= letters


def test_rows_of_one_id_and_clashing_names(spark, small):
    """A text that is near nothing stays, whatever rows share its id; all columns stay."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, row string, ids int, exact int, id int, others int"
    long_text = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (1, "a b c d e f g", "en", "s", 1), (1, "completely different text here now yes", "en", "s", 2), (2, "a b c d e f g", "en", "s", 3),
        (None, "x y z u v w", "en", "s", 4), (None, "x y z u v w", "en", "s", 5), (3, long_text, "en", "s", 6), (4, long_text, "en", "s", 7),
        (None, long_text, "en", "s", 8), (5, "", "en", "s", 9), (6, None, "en", "s", 10),
    ]
    docs = spark.createDataFrame([(*r, "k", "r", 1, 2, 3, 4) for r in rows], schema)
    kept = corpus_pipeline.drop_near_copies(spark, docs, small)
    assert kept.columns == docs.columns
    assert sorted(r.n_chars for r in kept.collect()) in ([1, 2, 4, 6, 9, 10], [1, 2, 5, 6, 9, 10])
    clean = corpus_pipeline.drop_contaminated(spark, kept, small)
    assert clean.columns == docs.columns and {(r.key, r.row) for r in clean.collect()} == {("k", "r")} and clean.count() == 6
    last = corpus_pipeline.to_tokens(spark, clean, small)
    assert last.columns == ["doc_id", "lang", "source", "n_chars", "key", "row", "ids_", "exact_", "id", "others", "ids", "n_tokens", "exact"]
    assert {(r.ids_, r.exact_, r.exact) for r in last.collect()} == {(1, 2, True)}
