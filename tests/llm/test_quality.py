"""Line rules and verdicts against a plain version."""

import duckdb
import pytest

from claimwright.llm import q_quality, quality
from tests.compare import differences
from tests.llm import plain

TEXTS = [
    None,
    "",
    " \n\t\n ",
    "Nine words are not enough for any text here.",
    "Ten words are just enough for a text to stay.",
    "The first line is a sentence with a full stop.\nHome | News | Sport | Contact\nAnd one more sentence that ends well.",
    "We use cookies to improve this site.\nThis long paragraph has more than ten words and should be kept whole.",
    "BUY!! NOW!! CHEAP!! GOODS!! HERE!! " * 3,
    "a$$$ b%%% c&&& d*** e### f g h i j k l",
    "Title\nA sentence of some length follows the title of this text here.",
    "same five words again here " * 10,
    "dup line\ndup line\n dup line\nother words that make up enough of them here now ok.",
    "Ünïcode wörds ärè çounted ås çharacters, ñot ås bytes, ïn æll ôf thís.",
    "R&D is fine & so is Q&A when a sentence has many more words than symbols in it, twenty or thirty of them, even forty of them at last, as here it does.",
    "x " * 30_000,
    "»» » one » two » three\n" + "plain words make a line of text that stays.\n" * 2,
    "ends with question?? and again?? in a line of only nine words",
    "tab\tseparated\x0bwords\x0cand\rreturns count as ten words in all of it",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 5, "y", True) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], 5, "y", True), (4, TEXTS[4], 5, "y", True)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string, base_failed boolean")


def test_measures_match_plain_version(docs):
    for r in quality.quality(docs).collect():
        measures, base_failed, kept, _ = plain.quality(TEXTS[4 if r.doc_id is None else r.doc_id])
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert (got, r.base_failed, r.kept) == (measures, base_failed, kept), r


def test_clean_text_matches_plain_version(docs):
    got = quality.clean(docs)
    assert got.columns == docs.columns
    by_id = {r.doc_id: r.text for r in got.collect()}
    for i, text in enumerate(TEXTS):
        _, _, kept, clean = plain.quality(text)
        assert (i in by_id) == kept, text
        if kept:
            assert by_id[i] == clean
    assert sum(r.doc_id == 4 for r in got.collect()) == 2 and None in by_id


@pytest.mark.parametrize("line", ["x" * 199, "x" * 5_000, "/long/path" * 30 + " " + "y" * 300, "x" * 5_000 + "."])
def test_long_lines_of_few_words(spark, line):
    """Lines of any length with fewer than three words fail unless they are closed."""
    text = "One sentence of twelve words stands beside the line in this text.\n" + line
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = quality.quality(docs).collect()
    measures, base_failed, kept, clean = plain.quality(text)
    closed = line.endswith(".")
    assert (row.n_words, row.word_chars) == measures[:2] and row.n_punctuation == (not closed)
    assert row.lost_chars == (0 if closed else len(line.replace(" ", "")))
    assert (row.base_failed, row.kept) == (base_failed, kept) and kept == closed
    assert [r.text for r in quality.clean(docs).collect()] == [clean] * kept


SCRIPTS = {
    "chinese": ["今天天气很好我们一起去公园散步。", "他说明天还会下雨所以要带伞！", "你觉得这个办法怎么样呢？", "这一行没有标点但是是一句完整的话"],
    "japanese": ["昨日は友達と映画を見に行きました。", "「とても面白かった」と彼は言った」", "次の週末も一緒に出かけましょう！"],
    "thai": ["วันนี้อากาศดีมากเราไปเดินเล่นกัน", "พรุ่งนี้ฝนอาจจะตกอีกครั้งหนึ่ง"],
    "devanagari": ["धन्यवाद।", "आजमौसमबहुतअच्छाहै", "चलो।"],
}


@pytest.mark.parametrize("script", SCRIPTS)
def test_scripts_without_spaces(spark, script):
    """Lines that are one word by their spaces, but sentences, stay."""
    lines = SCRIPTS[script]
    text = "\n".join(f"{line[:-1]}{i}{line[-1]}" if i else line for i in range(4) for line in lines)
    text += "\n" + " ".join(f"w{i}" for i in range(10)) + "."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = quality.quality(docs).collect()
    assert (row.n_punctuation, row.lost_chars, row.kept) == (0, 0, True)
    assert [r.text for r in quality.clean(docs).collect()] == [text] == [plain.quality(text)[3]]


@pytest.mark.parametrize("line", ["首页", "次へ", "मेनू", "———————————————", "12345678901234567890", "字字字字字字字字字字x", "٠١٢٣٤٥٦٧٨٩"])
def test_short_lines_of_any_script(spark, line):
    """Too few letters, no letters, or ASCII letters among them: short without a closer."""
    text = "One sentence of twelve words stands beside the line in this text.\n" + line
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = quality.quality(docs).collect()
    assert row.n_punctuation == 1 and row.lost_chars == len(line) and plain.failed_line(line)


def test_sql_knows_the_scripts(spark, tmp_path):
    """The query's SQL on lines of all scripts, beside those of the other tests."""
    texts = TEXTS + ["\n".join(lines) for lines in SCRIPTS.values()] + ["首页\n" + "字" * 100, "字" * 9 + "\n" + "字" * 10]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert differences(q_quality.document_quality(spark, str(tmp_path)), connection, q_quality.SQL) is None


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cleaned = {r.doc_id: r for r in quality.clean(docs).collect()}
    for r in docs.collect():
        _, _, kept, clean = plain.quality(r.text)
        assert (r.doc_id in cleaned) == kept
        if kept:
            assert cleaned[r.doc_id].text == clean and cleaned[r.doc_id].n_chars == len(clean)


def test_labelled_documents(spark):
    """Documents labelled good stay, most that are labelled bad go."""
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.quality(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_empty_table(docs):
    assert quality.quality(docs.limit(0)).count() == 0 and quality.clean(docs.limit(0)).count() == 0
