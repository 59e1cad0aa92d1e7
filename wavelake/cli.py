"""Command line: ``python -m wavelake.cli raw|emb|split ...``, or by spark-submit."""

from __future__ import annotations

import argparse
import json

from wavelake.operators.generators import GENERATORS, generate
from wavelake.plans.config import resolve_emb, resolve_prep
from wavelake.plans.pipeline import prepare_dataset, prepare_embeddings
from wavelake.session import local_session


def json_object(text: str) -> dict:
    try:
        value = json.loads(text)
    except ValueError as e:
        raise argparse.ArgumentTypeError(f"no JSON: {e}") from e
    if not isinstance(value, dict):
        raise argparse.ArgumentTypeError("not a JSON object")
    return value


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wavelake")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("raw", help="recordings to segments")
    r.add_argument("--dataset_name", required=True)
    r.add_argument("--dataset_dir", required=True)
    r.add_argument("--cache_dir")
    r.add_argument("--split_json")
    r.add_argument("--sr", type=int, default=16_000)
    r.add_argument("--mono", action=argparse.BooleanOptionalAction, default=True)
    r.add_argument("--seg_sec", type=float, default=10.0)
    r.add_argument("--hop_sec", type=float, default=10.0)
    r.add_argument("--tol_sec", type=float, default=0.0)
    r.add_argument("--label_type", choices=("weak", "strong"), default="weak")
    r.add_argument("--batch_size", type=int, default=16)
    r.add_argument("--overwrite", action="store_true")
    e = sub.add_parser("emb", help="segments to embeddings")
    e.add_argument("--cache_dir", required=True)
    e.add_argument("--model_name", required=True)
    e.add_argument("--granularity", choices=("clip", "frame"), required=True)
    e.add_argument("--output_dir", required=True)
    e.add_argument("--model_kwargs", type=json_object, default={})
    e.add_argument("--pretrained", action=argparse.BooleanOptionalAction, default=True)
    e.add_argument("--pretrained_dir")
    e.add_argument("--batch_size", type=int, default=32)
    e.add_argument("--overwrite", action="store_true")
    s = sub.add_parser("split", help="default split manifest")
    s.add_argument("--dataset_name", required=True)
    s.add_argument("--dataset_dir", required=True)
    s.add_argument("--output", required=True)
    return p


def main(argv: list[str] | None = None) -> str | None:
    a = vars(parser().parse_args(argv))
    command = a.pop("command")
    spark = local_session()
    if command == "split":
        generate(spark, a["dataset_name"], a["dataset_dir"], a["output"])
        return a["output"]
    if command == "raw":
        name, root = a.pop("dataset_name"), a.pop("dataset_dir")
        make = (lambda path: generate(spark, name, root, path)) if name in GENERATORS else None
        return prepare_dataset(spark, resolve_prep(name, root, a.pop("cache_dir"), a.pop("split_json"), generate=make, **a))
    raw, model, gran, out = a.pop("cache_dir"), a.pop("model_name"), a.pop("granularity"), a.pop("output_dir")
    return prepare_embeddings(spark, resolve_emb(spark, raw, model, gran, out, a.pop("model_kwargs"), **a))


if __name__ == "__main__":
    main()
