"""Command line for the end-to-end jobs (``python -m kinship.cli <job> ...``,
or through ``spark-submit``).

Question sets are given as ``name=path`` (repeatable), e.g.
``--questions dev=dev.jsonl --questions test=test.jsonl``.
"""

from __future__ import annotations

import argparse

from kinship.session import get_session


def _sets(items: list[str]) -> dict[str, str]:
    out = {}
    for it in items:
        name, _, path = it.partition("=")
        if not path:
            raise SystemExit(f"--questions expects name=path, got {it!r}")
        out[name] = path
    return out


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kinship")
    p.add_argument("--master", help="local master for runs outside spark-submit, e.g. local[8]")
    sub = p.add_subparsers(dest="job", required=True)

    e = sub.add_parser("exact", help="exact linkage: matched, unmatched, report")
    e.add_argument("--corpus", nargs="+", required=True)
    e.add_argument("--questions", action="append", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--keep", choices=["last", "first"], default="last")
    e.add_argument("--question-field", default="question_text")
    e.add_argument("--with-error", action="store_true", help="add a reason column to unmatched rows")

    k = sub.add_parser("keyed", help="keyed-store enrichment of every question")
    k.add_argument("--corpus-dirs", nargs="+", required=True)
    k.add_argument("--questions", action="append", required=True)
    k.add_argument("--out", required=True)
    k.add_argument("--glob", default="*.jsonl.gz")

    f = sub.add_parser("fuzzy", help="exact key, else best keyword Jaccard >= threshold")
    f.add_argument("--corpus", nargs="+", required=True)
    f.add_argument("--questions", action="append", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--threshold", type=float, default=0.9)

    c = sub.add_parser("candidates", help="top-k candidates per question")
    c.add_argument("--corpus", nargs="+", required=True)
    c.add_argument("--questions", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--threshold", type=float, default=0.3)
    c.add_argument("--k", type=int, default=3)
    c.add_argument("--num-files", type=int)
    c.add_argument("--num-questions", type=int)

    s = sub.add_parser("simplify", help="raw annotated records -> simplified records")
    s.add_argument("--input", nargs="+", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--per-input-file", action="store_true")
    s.add_argument("--lenient", action="store_true", help="quarantine bad records instead of failing")

    v = sub.add_parser("convert", help="raw annotated records -> short-answer QA pairs")
    v.add_argument("--input", nargs="+", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--max-tokens", type=int, default=5)
    v.add_argument("--seed", type=int)
    return p


def main(argv: list[str] | None = None) -> None:
    a = build_parser().parse_args(argv)
    spark = get_session(a.master)
    if a.job == "exact":
        from kinship.plans import exact_merge

        exact_merge.run(spark, a.corpus, _sets(a.questions), a.out, keep=a.keep,
                        question_field=a.question_field, with_error=a.with_error)
    elif a.job == "keyed":
        from kinship.plans import keyed_enrich

        keyed_enrich.run(spark, a.corpus_dirs, _sets(a.questions), a.out, path_glob=a.glob)
    elif a.job == "fuzzy":
        from kinship.plans import fuzzy_link

        fuzzy_link.run(spark, a.corpus, _sets(a.questions), a.out, threshold=a.threshold)
    elif a.job == "candidates":
        from kinship.plans import candidates

        candidates.run(spark, a.corpus, a.questions, a.out, threshold=a.threshold, k=a.k,
                       num_files=a.num_files, num_questions=a.num_questions)
    elif a.job == "simplify":
        from kinship.plans import corpus_prep

        corpus_prep.run_simplify(spark, a.input, a.out, per_input_file=a.per_input_file,
                                 strict=not a.lenient)
    elif a.job == "convert":
        from kinship.plans import corpus_prep

        corpus_prep.run_convert(spark, a.input, a.out, max_tokens=a.max_tokens, seed=a.seed)


if __name__ == "__main__":
    main()
