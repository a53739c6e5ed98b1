"""The commands end to end on small files: train, replay, stream, report, index, flights."""

import random

from brindle import __main__ as cli


def test_commands(spark, tmp_path, capsys):
    random.seed(2)
    (tmp_path / "reviews").mkdir()
    lines = ["asin,overall,reviewText,reviewerID,unixReviewTime"]
    lines += [f'i{i},{random.randint(1, 5)},"a ""b"",\nc",u{u},{i}' for u in range(30) for i in range(12)]
    (tmp_path / "reviews" / "r.csv").write_text("\n".join(lines) + "\n")

    def run(*args):
        cli.main([str(a) for a in args], spark)

    model, events, out = tmp_path / "model", tmp_path / "events", tmp_path / "out"
    run("train", "--input", tmp_path / "reviews", "--output", model)
    assert "rmse=" in capsys.readouterr().out
    run("replay", "--input", tmp_path / "reviews", "--model", model, "--output", events)
    assert "skipped=0" in capsys.readouterr().out
    run("stream", "--input", events, "--output", out, "--model", model, "--once")
    recs = spark.read.parquet(str(out / "recs"))
    assert recs.count() == 150
    run("report", "--input", out)
    shown = capsys.readouterr().out
    assert "probability" in shown and "share_over_budget" in shown


def test_index_and_flights_commands(spark, tmp_path):
    (tmp_path / "books").mkdir()
    (tmp_path / "books" / "1.txt").write_text("The cat and\nthe dog\n")
    cli.main(["index", "--input", str(tmp_path / "books"), "--output", str(tmp_path / "idx")], spark)
    lines = sorted(r[0] for r in spark.read.text(str(tmp_path / "idx" / "lines")).collect())
    assert lines == ["cat --> 1.txt:1", "dog --> 1.txt:1"]
    (tmp_path / "f.csv").write_text("FL_DATE,AIRLINE,AIRLINE_DOT,AIRLINE_CODE\n2023-01-01,Sky,x,SK\n")
    cli.main(["flights", "--input", str(tmp_path / "f.csv"), "--output", str(tmp_path / "fl"),
              "--question", "airline_summary"], spark)
    assert spark.read.parquet(str(tmp_path / "fl" / "airline_summary")).count() == 1
