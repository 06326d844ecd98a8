"""What queries leave in the shared folder: the tables that their results read, and nothing else."""

import os

import pytest

from weftline.llm import queries
from weftline.operators import graph

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op4_warc", "op7_url_filters", "op12_merkle_manifest"])
def test_nothing_else_is_left(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(graph, "shared_folder", lambda _: f"file://{tmp_path}")
    out = queries.QUERIES[name](spark, SF)
    reads = {f.removeprefix("file://").split("/part-")[0] for f in out.inputFiles()}
    left = {str(tmp_path / x) for x in os.listdir(tmp_path)}
    assert left == {x for x in reads if x.startswith(str(tmp_path))}
    assert out.count() > 0
