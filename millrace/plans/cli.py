"""Command line for the jobs: ``python -m millrace.plans.cli <job> [options]``.

Run it with ``spark-submit`` on a cluster (the cluster supplies the master)
or directly for a local run. Parameters can also come from a JSON file
(``--config``); command-line values win.

  decontaminate  --target_data F [F ...] --contaminant_source F --output_file_prefix P [--threshold 0.9] [--encoder M:F]
  deduplicate    --target_data F [F ...] --output_file_prefix P [--threshold 0.9] [--encoder M:F]
  prepare        --json_file_paths F [F ...] --output_dir D --merges_file M [--seq_length 32768]
  tokenize       --input_path D --output_dir D --merges_file M --vocab_file V [--seq_length 32768]
  pack           --input_path D --output_dir D [--seq_length 32768] [--oversize reject|own_pack]
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from millrace import constants as C
from millrace.operators.packing import BUCKET_DIGITS


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace")
    p.add_argument("--config", help="JSON file with default parameters")
    p.add_argument("--cache_dir", help="shared folder of parsed chat files: unchanged files are not parsed again")
    p.add_argument("--master", help="Spark master for a local run (omit under spark-submit)")
    sub = p.add_subparsers(dest="job", required=True)

    d = sub.add_parser("decontaminate")
    d.add_argument("--target_data", nargs="+", required=True)
    d.add_argument("--contaminant_source", required=True)
    d.add_argument("--output_file_prefix", required=True)
    d.add_argument("--threshold", type=float, default=C.SIM_THRESHOLD)
    d.add_argument("--output_format", default="json")
    d.add_argument("--encoder", help="module:function that loads a sentence encoder (default: term frequencies)")

    u = sub.add_parser("deduplicate")
    u.add_argument("--target_data", nargs="+", required=True)
    u.add_argument("--output_file_prefix", required=True)
    u.add_argument("--threshold", type=float, default=C.SIM_THRESHOLD)
    u.add_argument("--output_format", default="json")
    u.add_argument("--encoder", help="module:function that loads a sentence encoder (default: term frequencies)")

    r = sub.add_parser("prepare")
    r.add_argument("--json_file_paths", nargs="+", required=True)
    r.add_argument("--output_dir", required=True)
    r.add_argument("--seq_length", type=int, default=C.SEQ_LENGTH)
    r.add_argument("--merges_file", required=True, help="lengths are BPE tokens by this merges file")

    t = sub.add_parser("tokenize")
    t.add_argument("--input_path", required=True)
    t.add_argument("--output_dir", required=True)
    t.add_argument("--merges_file", required=True)
    t.add_argument("--vocab_file", required=True)
    t.add_argument("--seq_length", type=int, default=C.SEQ_LENGTH)
    t.add_argument("--handler", default="instruct_sft")
    t.add_argument("--id_col", default="record_id")

    k = sub.add_parser("pack")
    k.add_argument("--input_path", required=True)
    k.add_argument("--output_dir", required=True)
    k.add_argument("--seq_length", type=int, default=C.SEQ_LENGTH)
    k.add_argument("--max_segments", type=int, default=C.MAX_SEGMENTS)
    k.add_argument("--pad_id", type=int, default=C.PAD_ID)
    k.add_argument("--oversize", choices=["reject", "own_pack"], default="reject")
    k.add_argument("--id_col", default="id")
    k.add_argument("--bucket_digits", type=int, default=BUCKET_DIGITS)
    return p


def _loader(name: str | None):
    """The function that ``module:function`` names."""
    if not name:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def build_job(args: argparse.Namespace):
    from millrace.plans.jobs import DecontaminateJob, DeduplicateJob, PackJob, PrepareSplitJob, TokenizeJob
    if args.job == "decontaminate":
        return DecontaminateJob(args.target_data, args.contaminant_source, args.output_file_prefix,
                                args.threshold, args.output_format, _loader(args.encoder), args.cache_dir)
    if args.job == "deduplicate":
        return DeduplicateJob(args.target_data, args.output_file_prefix, args.threshold, args.output_format,
                              _loader(args.encoder), args.cache_dir)
    if args.job == "prepare":
        return PrepareSplitJob(args.json_file_paths, args.output_dir, args.merges_file, args.seq_length, args.cache_dir)
    if args.job == "tokenize":
        return TokenizeJob(args.input_path, args.output_dir, args.merges_file, args.vocab_file, args.seq_length,
                           args.handler, args.id_col)
    return PackJob(args.input_path, args.output_dir, args.seq_length, args.max_segments, args.pad_id,
                   args.oversize, args.id_col, args.bucket_digits)


def main(argv: list[str] | None = None, spark=None) -> dict[str, str]:
    argv = list(sys.argv[1:] if argv is None else argv)
    parser = _parser()
    args = parser.parse_args(argv)
    if args.config:
        with open(args.config, encoding="utf-8") as f:
            defaults = json.load(f)
        parser.set_defaults(**defaults)
        sub = parser._subparsers._group_actions[0].choices[args.job]  # noqa: SLF001 - argparse has no public accessor
        sub.set_defaults(**defaults)
        args = parser.parse_args(argv)
    if spark is None:
        from millrace.session import build_session
        spark = build_session(args.master)
    paths = build_job(args).run(spark)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
