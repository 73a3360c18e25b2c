import json
import os
import tempfile

from snapflow.__main__ import main
from snapflow.plans import bridge as B

SF = "/root/testdata/sf0.001"


def test_cli_land_and_daily(spark, capsys):
    root = tempfile.mkdtemp(prefix="cli-", dir=os.environ.get("TMPDIR", "/tmp"))
    docs = f"{root}/docs"
    os.makedirs(docs)
    with open(f"{docs}/d.jsonl", "w") as f:
        f.write(json.dumps({"repo_name": "r1", "stars": 3}) + "\n")
        f.write("{broken\n")
        f.write(json.dumps({"repo_name": "r2", "stars": 4}) + "\n")
    assert main(["land", "--docs", docs, "--key", "repo_name", "--key-path", "repo_name",
                 "--target", f"{root}/raw_data/github_repos"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"fetched": 3, "loaded": 2, "rejected": 1}
    B.package_documents(B.table(spark, SF, "orders")).write.parquet(f"{root}/raw_data/pypi_packages")
    spark.createDataFrame([("T1", "r1", "p1"), ("T2", "r2", None)],
                          "technology_name string, github_repo string, pypi_package string") \
        .write.parquet(f"{root}/mapping")
    assert main(["daily", "--root", root, "--mapping", f"{root}/mapping", "--no-gate", "--check", "report"]) == 0
    out = capsys.readouterr().out
    assert "dim_technologies.technology_name unique: 0" in out
    assert spark.read.parquet(f"{root}/marts/dim_technologies").count() == 2
