from __future__ import annotations

from pathlib import Path

from gondola.llm import base


def test_what_was_settled_can_be_discarded(spark):
    table = base.settle(spark.range(3), "numbers")
    assert table.count() == 3
    folder = Path(base.run_folder(spark))
    assert any(folder.iterdir())
    others = base.settle(spark.range(2), "more")
    assert others.count() == 2
    # Only this application's folder goes; it is made anew by the next one.
    kept = folder.parent / "another-application"
    kept.mkdir()
    assert base.discard(spark) and not folder.exists() and kept.exists()
    assert base.settle(spark.range(1), "numbers").count() == 1
