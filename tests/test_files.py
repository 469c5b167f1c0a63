import os

import pytest

from shelftalk.operators import dialog
from shelftalk.plans import dialogs
from shelftalk.sources import files
from shelftalk.sources.scratch import delete_tables, materialize, scratch_root

LINES = [
    'L1 +++$+++ u0 +++$+++ m0 +++$+++ BIANCA +++$+++ They "do not!',
    "L2 +++$+++ u1 +++$+++ m0 +++$+++ RENÉ +++$+++ café, déjà",
    "L3 +++$+++ u0 +++$+++ m0 +++$+++ X +++$+++ ",
    "L4 +++$+++ u0 +++$+++ m0 +++$+++ X +++$+++ Go away.",
]
CONVERSATION = "u0 +++$+++ u1 +++$+++ m0 +++$+++ ['L1', 'L2', 'L3', 'L4']"


@pytest.fixture
def dialog_files(tmp_path):
    lines, conversations = tmp_path / "lines.txt", tmp_path / "conversations.txt"
    lines.write_bytes("\n".join(LINES).encode("iso-8859-1"))
    conversations.write_bytes(CONVERSATION.encode("iso-8859-1"))
    return str(lines), str(conversations)


def test_line_records(spark, dialog_files):
    got = {r.lineID: r for r in files.read_lines(spark, dialog_files[0]).collect()}
    assert got["L1"].text == 'They "do not!' and got["L2"].text == "café, déjà"
    assert got["L2"].character == "RENÉ" and got["L3"].text == ""


def test_last_line_of_an_id_stays_and_bad_bytes_go(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_bytes((LINES[0] + "\n" + LINES[3].replace("L4", "L1")).encode() + b" \xff!")
    got = files.read_lines(spark, str(path), ("lineID", "text"), "UTF-8").collect()
    assert [tuple(r) for r in got] == [("L1", "Go away. !")]


def test_pairs_of_both_forms(spark, dialog_files):
    said = dialogs.utterances(spark, *dialog_files)
    assert [r.text for r in said.orderBy("pos").collect()][2] == ""
    assert [(r.input, r.target) for r in dialog.dialog_pairs(said).collect()] == [('They "do not!', "café, déjà")]
    capped = dialog.dialog_pairs_capped(said).orderBy("pos").collect()
    assert [(r.input, r.target) for r in capped] == [("they do not !", "caf , d j"), ("caf , d j", ""), ("", "go away .")]


def test_unknown_line_is_an_error(spark, dialog_files, tmp_path):
    path = tmp_path / "c.txt"
    path.write_text(CONVERSATION.replace("L4", "L9"))
    with pytest.raises(Exception, match="unknown line id"):
        dialogs.utterances(spark, dialog_files[0], str(path)).collect()


def test_conversations_keep_file_order(spark, dialog_files, tmp_path):
    path = tmp_path / "c.txt"
    path.write_text("\n".join(f"u0 +++$+++ u1 +++$+++ m0 +++$+++ ['L{a}', 'L{b}']" for a, b in ((4, 1), (2, 4), (1, 2))))
    got = dialogs.utterances(spark, dialog_files[0], str(path)).where("pos = 0").orderBy("conv_id").collect()
    assert [(r.conv_id, r.text) for r in got] == [(0, "Go away."), (1, "café, déjà"), (2, 'They "do not!')]


def test_pair_file(spark, tmp_path):
    pairs = spark.createDataFrame([('say "hi"', "plain"), ("a, b", "")], "input string, target string")
    files.write_pairs(pairs.coalesce(1), str(tmp_path / "p"))
    got = files.read_pairs(spark, str(tmp_path / "p")).orderBy("_file", "_block", "_at").select("input", "target")
    assert [tuple(r) for r in got.collect()] == [('"say ""hi"""', "plain"), ("a, b", '""')]


def test_csv_with_index_and_quotes(spark, tmp_path):
    path = tmp_path / "own.csv"
    path.write_text(',title,rating\n0,"Stories, 4: ""The End""",4\n7,Ubik,5\n')
    got = files.read_table(spark, str(path), files.OWN_RATINGS, drop_index=True)
    assert got.columns == ["title", "rating"]
    assert [tuple(r) for r in got.collect()] == [('Stories, 4: "The End"', 4), ("Ubik", 5)]
    files.write_table(got, str(tmp_path / "out"))
    back = files.read_table(spark, str(tmp_path / "out"), "title string, rating int")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, got.collect()))
    assert [r.value for r in files.preview(spark, str(path), 1).collect()] == [",title,rating"]


def test_vocabulary_file(spark, tmp_path, rows):
    words = spark.createDataFrame([("hi", 3, 2), ("", 4, 1)], "word string, index long, n long")
    files.write_vocabulary(words, str(tmp_path / "v"))
    assert rows(files.read_vocabulary(spark, str(tmp_path / "v"))) == rows(words)


def test_scratch_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == folder
    before = set(os.listdir(folder))
    stored = materialize(spark.range(3))
    assert stored.count() == 3 and len(set(os.listdir(folder)) - before) == 1
    assert all(f"{folder}/" in f for f in stored.inputFiles())
    delete_tables(spark, [stored])
    assert set(os.listdir(folder)) == before


def test_short_record_is_an_error(spark, tmp_path):
    sep = files.FIELD_SEPARATOR
    whole, more, empty = ["L1", "u0", "m0", "BIANCA", "Hi."], list("abcdef"), ["L2", "", "", "", ""]
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(sep.join(r) for r in (whole, more, empty)) + "\n")
    rows = files.read_fields(spark, str(path), files.LINE_FIELDS).orderBy("lineID").collect()
    assert [[r[c] for c in files.LINE_FIELDS] for r in rows] == [whole, empty, more[:5]]
    path.write_text(sep.join(whole) + "\n" + sep.join(whole[:3]) + "\n")
    with pytest.raises(Exception, match="too few fields"):
        files.read_fields(spark, str(path), files.LINE_FIELDS).select("text").collect()
