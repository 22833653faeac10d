import json

import pytest

from brightloom.__main__ import main


def test_count_words(spark, tmp_path, capsys):
    (tmp_path / "in.txt").write_text("a  b a\n")
    main(["count-words", "-i", str(tmp_path / "in.txt"), "-o", str(tmp_path / "out"), "--whitespace"])
    assert sorted(map(tuple, spark.read.csv(str(tmp_path / "out"), header=True).collect())) == [("a", "2"), ("b", "1")]
    main(["count-words", "-i", str(tmp_path / "in.txt")])
    assert "word|count" in capsys.readouterr().out


def test_table_jobs(spark, tmp_path):
    lines = ["id\tx\ty"] + [f"r{i}\t{i % 7}\t{5000 if i == 3 else i % 2}" for i in range(40)]
    (tmp_path / "in.tsv").write_text("\n".join(lines) + "\n")
    clean, model, out, costs = (str(tmp_path / name) for name in ("clean", "model", "out", "costs"))
    main(["clean-table", "-i", str(tmp_path / "in.tsv"), "-o", clean, "--first-column", "1", "--exact"])
    assert spark.read.csv(clean, sep="\t", header=True, inferSchema=True).selectExpr("max(y)").first()[0] == 1
    main(["train-clusters", "-i", clean, "--model", model, "--k", "3", "--schema", "x double, y double"])
    main(["predict-clusters", "-i", clean, "--model", model, "-o", out])
    assert spark.read.csv(out, sep="\t", header=True).columns == ["x", "y", "cluster"]
    main(["sweep-clusters", "-i", clean, "-o", costs])
    assert spark.read.csv(costs, header=True).count() == 13


def test_text_jobs(spark, tmp_path):
    rows = ["ItemID,Sentiment,SentimentText"]
    rows += [f'{i},{i % 2},"{"joyful café" if i % 2 else "dreadful"} ""word{i}"", #t"' for i in range(200)]
    (tmp_path / "data.csv").write_bytes("\n".join(rows).encode("latin-1"))
    (tmp_path / "cases").mkdir()
    case = {"X": [{"1": "so joyful", "0": "Dreadful!"}], "y": [{"0": 0, "1": 0}]}
    (tmp_path / "cases" / "first.json").write_text(json.dumps(case))
    (tmp_path / "messages.txt").write_text("a joyful day\n\ndreadful\n")
    model, runs, tests, out, rejects = (str(tmp_path / n) for n in ("model", "runs", "tests", "out", "rejects"))

    (tmp_path / "stop.txt").write_text("café\nthe\n")
    train = ["train-text", "-i", str(tmp_path / "data.csv"), "--model", model, "--runs", runs, "--alpha", "0.5"]
    for more in ([], ["--stop-words", str(tmp_path / "stop.txt")]):
        main(train + more)
    terms = {row["term"] for row in spark.read.parquet(model + "/terms").collect()}
    assert "joyful" in terms and "café" not in terms
    records = spark.read.json(runs).collect()
    assert len(records) == 2 and records[0]["accuracy"] == 1.0 and records[0]["alpha"] == 0.5

    main(["score-text", "-i", str(tmp_path / "messages.txt"), "--model", model, "-o", out, "--rejects", rejects])
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [
        ("a joyful day", "Positive sentiment"), ("dreadful", "Negative sentiment")
    ]
    assert spark.read.parquet(rejects).count() == 1

    main(["evaluate-text", "-i", str(tmp_path / "cases"), "--model", model, "--runs", tests])
    record = spark.read.json(tests).first()
    assert (record["test_path"], record["accuracy"]) == ("first.json", 0.5)
    assert record["report"].startswith("0: precision 1.00 recall 0.50")


def test_unknown_command():
    with pytest.raises(SystemExit):
        main(["serve"])
