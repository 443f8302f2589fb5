"""Lines with their byte offsets, whatever the split size."""

import gzip
import json
from urllib.parse import unquote

import pytest

from millrace.sources.chats import read_chat_jsonl
from millrace.sources.lines import OPEN_BYTES, read_lines, splits


def _expected(data: bytes) -> list[tuple[int, str]]:
    out, at = [], 0
    for line in data.split(b"\n"):
        text = line.rstrip(b"\r")
        if at == 0 and text.startswith(b"\xef\xbb\xbf"):
            text = text[3:]
        if text.strip():
            out.append((at, text.decode()))
        at += len(line) + 1
    return out


def _chat(q: str) -> str:
    return json.dumps({"conversations": [{"from": "human", "value": q}, {"from": "gpt", "value": "a"}]}, ensure_ascii=False)


FILES = {
    "plain.jsonl": "".join(_chat(f"question {k} " + "x" * (k * 7 % 90)) + "\n" for k in range(200)).encode(),
    "no end é.jsonl": "\n\n".join(_chat(f"é {k}") for k in range(9)).encode(),
    "crlf.jsonl": b"\xef\xbb\xbf" + "\r\n".join(_chat(f"c{k}") for k in range(9)).encode() + b"\r\n  \r\n",
    "one long.jsonl": (_chat("w" * 300_000) + "\n" + _chat("short") + "\n").encode(),
    "blank.jsonl": b"\n\n \n",
    "empty.jsonl": b"",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("lines")
    for name, data in FILES.items():
        (path / name).write_bytes(data)
    (path / "packed.jsonl.gz").write_bytes(gzip.compress(FILES["plain.jsonl"]))
    return path


def _rows(df):
    return sorted((unquote(r["source_path"].rsplit("/", 1)[1]), r["offset"], r["line"]) for r in df.collect())


@pytest.mark.parametrize("split_bytes", [997, 4096, 128 << 20])
def test_offsets_do_not_depend_on_the_splits(spark, folder, split_bytes):
    want = sorted((name, at, text) for name, data in
                  [*FILES.items(), ("packed.jsonl.gz", FILES["plain.jsonl"])] for at, text in _expected(data))
    assert _rows(read_lines(spark, str(folder), split_bytes)) == want


def test_every_cut_gives_each_line_once(tmp_path):
    from millrace.sources.lines import Range, _lines
    data = b"a\n\nbb\r\nccc\n" + b"d" * 20 + b"\n\xc3\xa9"
    (tmp_path / "f").write_bytes(data)
    whole = list(_lines(Range(str(tmp_path / "f"), 0, 0, None)))
    for size in range(1, len(data) + 2):
        cut = [x for s in range(0, len(data), size)
               for x in _lines(Range(f"file:{tmp_path}/f", 0, s, min(len(data), s + size)))]
        assert cut == whole


def test_small_files_share_a_split_and_large_ones_are_cut():
    got = splits([("big", 250 << 20, 1), ("a", 10, 1), ("b.gz", 400 << 20, 1), ("c", 0, 1), ("d", 10, 1)], 128 << 20)
    ranges = [(r.path, r.start, r.end) for s in got for r in s.ranges]
    assert sorted(ranges) == [("a", 0, 10), ("b.gz", 0, None), ("big", 0, 128 << 20),
                              ("big", 128 << 20, 250 << 20), ("d", 0, 10)]
    many = splits([(f"f{k:03}", 10, 1) for k in range(100)], 16 * (OPEN_BYTES + 10))
    assert [len(s.ranges) for s in many] == [16] * 6 + [4]


def test_chat_positions_are_the_same_in_every_layout(spark, folder):
    def ids(split_bytes):
        rows = read_chat_jsonl(spark, [str(folder / "plain.jsonl"), str(folder / "crlf.jsonl")], split_bytes=split_bytes)
        return sorted((r["source_pos"]["file"].rsplit("/", 1)[1], r["source_pos"]["offset"], r["conversations"][0]["value"])
                      for r in rows.collect())
    small = ids(512)
    assert small == ids(64 << 20) and len(small) == 209
    assert [v for f, _, v in small if f == "crlf.jsonl"] == [f"c{k}" for k in range(9)]


def test_no_files_with_lines(spark, folder):
    assert read_lines(spark, [str(folder / "empty.jsonl"), str(folder / "blank.jsonl")]).count() == 0
