"""The command line drives the same jobs."""

import json

from millrace.plans.cli import main


def test_cli_decontaminate_and_config(spark, tmp_path):
    chats = tmp_path / "t.jsonl"
    chats.write_text("\n".join(json.dumps({"conversations": [{"from": "human", "value": q}, {"from": "gpt", "value": "a"}]})
                               for q in ["the cat sat on the mat", "dogs run fast"]) + "\n")
    (tmp_path / "b.json").write_text(json.dumps({"k": "the cat sat on the mat"}))
    cfg = tmp_path / "cfg.json"
    cfg.write_text(json.dumps({"threshold": 0.5}))
    paths = main(["--config", str(cfg), "decontaminate", "--target_data", str(chats),
                  "--contaminant_source", str(tmp_path / "b.json"),
                  "--output_file_prefix", str(tmp_path / "out")], spark=spark)
    assert spark.read.json(paths["contaminated"]).count() == 1
    assert [r["question"] for r in spark.read.json(paths["decontaminated"]).collect()] == ["dogs run fast"]
