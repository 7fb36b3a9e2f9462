import json

import golden
import pytest

from quire import cli
from quire.sources import parser_dirs as D
from quire.sources import writers as W


def folder(root, name, **files):
    p = root / name
    (p / "images").mkdir(parents=True)
    for i in golden.IMAGES:
        (p / i).write_bytes(b"x")
    for k, v in files.items():
        (p / k.replace("__", ".")).write_text(v)
    return p


A = "Guide.pdf-0123abcd-0123-0123-0123-0123456789ab"


def test_roles_and_choice(spark, tmp_path):
    folder(tmp_path, A, x_content_list_v2__json="[]", content_list_v2__json="[]", content_list__json="[]", full__md="x", x_origin__pdf="x")
    folder(tmp_path, "B", b_content_list__json="[]")
    rows = {r.dirname: r for r in D.discovered(D.listing(spark, str(tmp_path))).collect()}
    assert set(rows[A].files_all) == {"origin_pdf", "content_list_v2", "content_list", "full_md", "images_dir"}
    assert "content_list" not in rows[A].files_used and rows[A].files_used["content_list_v2"].endswith("x_content_list_v2.json")
    assert "content_list" in rows["B"].files_used


def test_missing_list(spark, tmp_path):
    folder(tmp_path, A, full__md="x")
    with pytest.raises(ValueError):
        D.load_pages(spark, str(tmp_path))


def test_cli_run(spark, tmp_path):
    root = tmp_path / "in"
    folder(root, A, content_list_v2__json=json.dumps(golden.PAGES))
    folder(root, "Broken", content_list_v2__json="[[{bad")
    folder(root, "Nothing", full__md="x")
    total = cli.run(spark, str(root), str(tmp_path / "out"), str(tmp_path / "shared"), lenient=True)
    assert {k: total[k] for k in golden.STATS} == golden.STATS
    guide = next(p for p in (tmp_path / "out").iterdir() if p.name.startswith("Guide_"))
    assert sorted(p.name for p in guide.iterdir()) == ["README_kb.md", "error_report.json", "kb_chunks.jsonl", "kb_manifest.json"]
    rows = [json.loads(x) for x in (guide / "kb_chunks.jsonl").read_text().splitlines()]
    assert [(r["content_type"], r["chunk_id"].rsplit(":", 1)[1]) for r in rows] == [(c[0], str(i)) for i, c in enumerate(golden.CHUNKS, 1)]
    assert all(list(r) == list(W.SIX) for r in rows)
    m = json.loads((guide / "kb_manifest.json").read_text())
    assert m["output_files"]["chunks_jsonl"] == str(guide / "kb_chunks.jsonl") and m["stats"]["total_chunks"] == 4 and m["chunking_policy"]["type_mapping"]["image"] == "figure"
    assert m["input_files_used"]["content_list_v2"].endswith("content_list_v2.json") and m["source_pdf"] == ""
    r = json.loads((guide / "error_report.json").read_text())
    assert r["summary"] == {"total_missing_images": 1, "total_skipped_blocks": 7, "total_unsupported_blocks": 1, "total_parse_errors": 1}
    assert all(len(r[k]) == r["summary"][f"total_{k}"] for k in W.CATEGORIES) and "oversized_table_chunks" not in r
    assert "| Chunks in all | 4 |" in (guide / "README_kb.md").read_text()
    broken = next(p for p in (tmp_path / "out").iterdir() if p.name.startswith("Broken_"))
    assert json.loads((broken / "error_report.json").read_text())["summary"]["total_parse_errors"] == 1 and (broken / "kb_chunks.jsonl").read_text() == ""
    assert [p.name for p in (tmp_path / "shared").iterdir()] == ["Guide.jsonl"] and len((tmp_path / "shared/Guide.jsonl").read_text().splitlines()) == 4
    assert "weak figures left out: 1" in cli.report(total)


def test_lines_go_to_files_of_any_name(spark, tmp_path):
    root = f"file://{tmp_path}/out put"
    rows = [(f"{root}/a ü%20+.jsonl", 2, "zwei"), (f"{root}/a ü%20+.jsonl", 1, "eins"), (f"{tmp_path}/plain.jsonl", 1, "x"), (f"{root}/empty", 1, None), (None, 1, "lost")]
    done = W.write_lines(spark.createDataFrame(rows, "file string, seq int, line string"), ["seq"]).collect()
    assert {(r.file, r.lines) for r in done} == {(rows[0][0], 2), (rows[2][0], 1), (rows[3][0], 0)}
    assert (tmp_path / "out put/a ü%20+.jsonl").read_text() == "eins\nzwei\n" and (tmp_path / "plain.jsonl").read_text() == "x\n" and (tmp_path / "out put/empty").read_text() == ""
    assert len(list((tmp_path / "out put").iterdir())) == 2


def test_default_folder(spark, tmp_path):
    folder(tmp_path, A, content_list_v2__json=json.dumps(golden.PAGES))
    cli.run(spark, str(tmp_path))
    assert len((tmp_path / A / "output/kb_chunks.jsonl").read_text().splitlines()) == 4
    assert {r.dirname for r in D.discovered(D.listing(spark, str(tmp_path))).collect()} == {A}


def test_stream(spark, tmp_path):
    from quire.operators.nested import PAGES
    from quire.streaming.files import packed_stream

    src = spark.createDataFrame([(1, "d", json.dumps(golden.PAGES))], "file_id bigint, doc_id string, j string").selectExpr("file_id", "doc_id", f"from_json(j, '{PAGES.simpleString()}') as pages")
    src.write.parquet(str(tmp_path / "src"))
    q = packed_stream(spark, str(tmp_path / "src"), src.schema, lambda p, n: p.minimal().write.mode("overwrite").parquet(str(tmp_path / f"out/{n}")), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out/0")).count() == 4
