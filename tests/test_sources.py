import pytest
from pyspark.sql import functions as F

from evenkeel.sources.runlogs import EPOCH_LOG_LAYOUTS, RESULT_LAYOUTS, read_ragged_log, summary_table, write_summary
from evenkeel.sources.tables import LABEL, TEXT, load_labeled, read_table, write_predictions, write_table, write_text_label

ROWS = [
    ("1", 'say "hi", ok', 0),
    ("2", "two\nlines", 1),
    ("10", " padded ", 2),
    ("3", "semi;colon", 3),
    ("x_1", "back\\slash", 4),
    ("x_0", "crlf\r\nend", 5),
]


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(ROWS, "index string, message string, label int")


@pytest.mark.parametrize("sep", [",", ";"])
def test_texts_survive_files(spark, labelled, tmp_path, sep):
    path = str(tmp_path / "t")
    write_table(labelled.select("index", "message"), path, sep=sep)
    got = {r["index"]: r.message for r in read_table(spark, path, TEXT, sep=sep).collect()}
    assert got == {i: m for i, m, _ in ROWS}


def test_single_file_with_line_breaks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('index,message\n1,"a\nb ""c"", d"\nid_2,\n3,null\n', encoding="utf-8")
    got = {r["index"]: r.message for r in read_table(spark, str(path), TEXT).collect()}
    assert got == {"1": 'a\nb "c", d', "id_2": None, "3": "null"}
    got = {r["index"]: r.message for r in read_table(spark, str(path), TEXT, na_values=["null"]).collect()}
    assert got["3"] is None


def test_wrong_header_fails(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,text\n1,a\n")
    with pytest.raises(Exception):
        read_table(spark, str(path), TEXT).collect()


def test_columns_by_name_and_missing_numbers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('extra;full_text;category_id\nz;"a; b";0\ny;c;N/A\n')
    got = read_table(spark, str(path), "category_id int, full_text string", sep=";", na_values=["N/A"]).collect()
    assert [tuple(r) for r in got] == [(0, "a; b"), (None, "c")]
    with pytest.raises(Exception):
        read_table(spark, str(path), "category_id int", sep=";").collect()


def test_optional_labels(spark, labelled, tmp_path):
    text, label = write_text_label(labelled, str(tmp_path))
    assert "label" in load_labeled(spark, text, label).columns
    assert load_labeled(spark, text, label).count() == len(ROWS)
    assert load_labeled(spark, text, str(tmp_path / "none")).columns == ["index", "message"]
    assert load_labeled(spark, text).count() == len(ROWS)


def test_predictions_ascend_numbers_first(spark, labelled, tmp_path):
    path = tmp_path / "p"
    write_predictions(labelled.select("index", "label"), str(path))
    lines = [line for part in sorted(path.glob("part-*")) for line in part.read_text().splitlines()[1:]]
    assert lines == ["1,0", "2,1", "3,3", "10,2", "x_0,5", "x_1,4"]
    write_predictions(labelled.select("index", "label"), str(path), compression="gzip")
    assert list(path.glob("*.gz"))
    assert read_table(spark, str(path), LABEL).count() == len(ROWS)


def test_ragged_epoch_log(spark, tmp_path):
    path = tmp_path / "log.csv"
    wide = EPOCH_LOG_LAYOUTS[21]
    row21 = [f"v{i}" for i in range(21)]
    row13 = ["t", "m", '"k, with comma"', "5 Folds", "N/A", "N/A", "N/A", "0.55", "N/A", "64", "64", "2e-05", "cuda"]
    row14 = row13[:12] + ["8", "cpu"]
    path.write_text("\n".join([",".join(wide), ",".join(row21), ",".join(row13), ",".join(row14)]) + "\n")
    got = {r.n_fields: r.asDict() for r in read_ragged_log(spark, str(path), EPOCH_LOG_LAYOUTS).collect()}
    assert got[21]["Num GPUs"] == "v20" and got[21]["val_f1_macro"] == "v7"
    assert got[13]["val_f1_macro"] == "0.55" and got[13]["Learning Rate"] == "2e-05" and got[13]["Device"] == "cuda"
    assert got[13]["Model Key"] == "k, with comma" and got[13]["train_loss"] is None
    assert got[14]["LORA_R"] == "8" and got[14]["Device"] == "cpu" and got[13]["LORA_R"] is None


def test_ragged_results_and_unknown_width(spark, tmp_path):
    path = tmp_path / "r.csv"
    lines = [",".join(RESULT_LAYOUTS[11])] + [",".join(f"{n}_{i}" for i in range(n)) for n in (11, 12, 14)]
    path.write_text("\n".join(lines) + "\n")
    got = {r.n_fields: r for r in read_ragged_log(spark, str(path), RESULT_LAYOUTS).collect()}
    assert got[11].test_f1_macro == "11_7" and got[12].test_f1_macro == "12_8" and got[14].test_f1_macro == "14_10"
    assert got[11].model_key is None and got[14].val_recall_macro == "14_9"
    path.write_text("a,b,c\n")
    with pytest.raises(Exception, match="no layout"):
        read_ragged_log(spark, str(path), RESULT_LAYOUTS).collect()


def test_summary(spark, tmp_path):
    scores = spark.createDataFrame([("a", 0.4), ("b", 0.6)], "Model string, `F1 (Macro)` double")
    path = str(tmp_path / "s")
    write_summary(summary_table(scores, {"max_length": 64, "learning_rate": 2e-5}), path)
    got = spark.read.json(path).select("*", F.col("config.max_length").alias("len")).head()
    assert (got.models_trained, got.best_model, got.best_f1_macro, got.len) == (["a", "b"], "b", 0.6, 64)


def test_each_file_has_its_own_header(spark, tmp_path):
    """Columns are found by name in every file, in whatever order and beside whatever others they stand."""
    folder = tmp_path / "some files"
    folder.mkdir()
    (folder / "a.csv").write_text("index,message\n1,one\n")
    (folder / "b.csv").write_text("message,index\ntwo,2\n")
    (folder / "c.csv").write_text('note,index,message\nx,3,"three\nlines"\n')
    (folder / "d.csv").write_text("index,message\n4,four\n")
    want = {"1": "one", "2": "two", "3": "three\nlines", "4": "four"}
    assert {r["index"]: r.message for r in read_table(spark, str(folder), TEXT).collect()} == want
    files = [str(folder / f"{n}.csv") for n in "abcd"]
    assert {r["index"]: r.message for r in read_table(spark, files, TEXT).collect()} == want
    (folder / "e.csv").write_text("index,text\n5,five\n")
    with pytest.raises(Exception):
        read_table(spark, str(folder), TEXT).collect()
