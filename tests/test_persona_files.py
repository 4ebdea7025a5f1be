"""Folders of many small JSON files."""

import shutil

from weftline.sources import tables


def test_files_are_read_once_and_many_to_a_task(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(150):
        (folder / f"{i}.json").write_text(f'{{"id": {i}' + (f', "name": "n{i}"}}' if i % 3 else "}"))
    (folder / "x.json").write_text("{")
    (folder / "note.txt").write_text('{"id": 999, "name": "no"}')
    good, bad = tables.persona_files(spark, str(folder), "id long, name string", ["id", "name"])
    shutil.rmtree(folder)
    assert sorted((r.id, r.name) for r in good.collect()) == [(i, f"n{i}") for i in range(150) if i % 3]
    assert sorted((r.path.rsplit("/", 1)[1], r.broken, r.missing, r.found and r.found.id) for r in bad.collect()) == sorted([(f"{i}.json", False, ["name"], i) for i in range(0, 150, 3)] + [("x.json", True, ["id", "name"], None)])
    assert len(good.inputFiles()) <= tables.TASKS * spark.sparkContext.defaultParallelism
