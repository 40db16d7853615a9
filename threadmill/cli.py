"""python -m threadmill.cli COMMAND: check, parse, stats, rank, voice, run, verify, promote, ledger, paths."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill import config
from threadmill.operators import authorship, catalog, chunks, profile, review, shortlist, turns, verify
from threadmill.session import hadoop_path, local_session, scratch, stored
from threadmill.sources import exports, markdown, sinks


def session() -> SparkSession:
    """The caller's session, or the one spark-submit configures; a local one only where nothing names a master."""
    return SparkSession.getActiveSession() or (SparkSession.builder.getOrCreate() if SparkConf().contains("spark.master") else local_session())


def _today(given: str | None) -> str:
    return given or dt.date.today().isoformat()


def _arguments() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="threadmill")
    sub = ap.add_subparsers(dest="command", required=True)

    def add(name: str, *flags: str, source: str | None = None) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.add_argument("--config")
        if source:
            p.add_argument("source", help=source)
        if "out" in flags:
            p.add_argument("--out", default="workspace")
        if "limit" in flags:
            p.add_argument("--limit", type=int, help="only the first conversations of the export")
        if "rank" in flags:
            p.add_argument("--ledger", help="a JSON ledger (default: the configured path)")
            p.add_argument("--include-reviewed", action="store_true")
        if "force" in flags:
            p.add_argument("--force", action="store_true")
        if "as_of" in flags:
            p.add_argument("--as-of", help="the day that ages count to (default: today)")
            p.add_argument("--top", type=int)
        return p

    export = "a JSON file, a zip, a folder of shards or a parquet table"
    add("check", source=export)
    add("parse", "out", "limit", source=export)
    add("stats", "limit", source=export)
    add("rank", "out", "limit", "rank", "force", "as_of", source=export)
    add("voice", "out", "limit", "rank", source=export)
    add("run", "out", "limit", "rank", "force", "as_of", source=export)
    against = add("verify", source="a folder of notes").add_mutually_exclusive_group(required=True)
    against.add_argument("--export")
    against.add_argument("--transcripts", help="a folder of transcripts instead of the export")
    gate = add("promote", source="a folder of staged notes")
    gate.add_argument("--export", required=True)
    gate.add_argument("--notes", help="where notes go (default: the configured path)")
    gate.add_argument("--ledger")
    gate.add_argument("--replace", action="store_true")
    gate.add_argument("--check", action="store_true", help="run every check, write nothing")
    led = sub.add_parser("ledger")
    led.add_argument("action", choices=["sync", "mark", "show"])
    led.add_argument("stems", nargs="*")
    led.add_argument("--config")
    led.add_argument("--index", required=True, help="the index that parse wrote")
    led.add_argument("--transcripts", help="where ids are looked up that the index lacks")
    led.add_argument("--shortlist")
    led.add_argument("--ledger")
    led.add_argument("--status", choices=["reviewed", "promoted"], default="reviewed")
    led.add_argument("--as-of")
    sub.add_parser("paths").add_argument("--config")
    return ap


def _index(spark: SparkSession, args: argparse.Namespace, cfg: config.Config) -> tuple[DataFrame, DataFrame]:
    conversations = exports.read(spark, args.source)
    if getattr(args, "limit", None):
        conversations = catalog.first(conversations, args.limit)
    return catalog.index(conversations, cfg)


def _parse(rows: DataFrame, said: DataFrame, args: argparse.Namespace) -> None:
    sinks.write_index(rows, args.out)
    markdown.write_files(markdown.render(rows, said), f"{args.out}/conversations")


def _rank(spark: SparkSession, rows: DataFrame, args: argparse.Namespace, cfg: config.Config) -> None:
    ledger, _ = exports.read_ledger(spark, args.ledger or cfg.paths["ledger"])
    scored = shortlist.review_state(shortlist.scored(rows, cfg, _today(args.as_of)), ledger)
    if not args.include_reviewed:
        scored = scored.where("review_state is null or review_state <> 'reviewed'")
    sinks.write_text(spark, f"{args.out}/SHORTLIST.md", sinks.shortlist_text(scored, cfg, "archive/conversations/"), args.force)


def _voice(spark: SparkSession, rows: DataFrame, said: DataFrame, args: argparse.Namespace, cfg: config.Config) -> None:
    blocks = chunks.blocks(rows, said, cfg.min_user_words).withColumn("tokens", chunks.tokens(F.col("text")))
    sinks.write_years(blocks, args.out)
    ledger, _ = exports.read_ledger(spark, args.ledger or cfg.paths["ledger"])
    fresh = rows if args.include_reviewed else chunks.unreviewed(rows, ledger)
    sinks.write_chunks(chunks.pack(blocks.join(fresh.select("conv_no"), "conv_no", "left_semi"), cfg.chunk_tokens), cfg.chunk_tokens, args.out)


def _promote(spark: SparkSession, args: argparse.Namespace, cfg: config.Config) -> int:
    notes = markdown.read(spark, args.source).where("not file like '\\\\_%'")
    rows, said = catalog.index(exports.read(spark, args.export), cfg)
    folder = args.notes or cfg.paths["notes"]
    present = None if args.replace else markdown.read(spark, folder).select("file")
    problems = stored(review.note_problems(notes, rows, verify.check(notes, said), present))
    refused = problems.where(F.size("problems") > 0)
    refused.select("file", F.array_join("problems", "; ").alias("problems")).show(1000, False)
    if not args.check:
        path = args.ledger or cfg.paths["ledger"]
        ledger, pending = exports.read_ledger(spark, path)
        passed, waiting = review.promote(notes, problems, pending, rows)
        sinks.put_notes(passed, folder)
        sinks.write_text(spark, path, exports.ledger_json(ledger, waiting), True)
    return int(not refused.isEmpty())


def _ledger(spark: SparkSession, args: argparse.Namespace, cfg: config.Config) -> int:
    path = args.ledger or cfg.paths["ledger"]
    rows = markdown.read_index(spark, args.index, args.transcripts)
    ledger, pending = exports.read_ledger(spark, path)
    if args.action == "show":
        review.state_counts(rows, ledger).orderBy("state").show(20, False)
        return 0
    on = _today(args.as_of)
    if args.action == "mark":
        ledger, lacking = review.mark_stems(ledger, rows, spark.createDataFrame([(s,) for s in args.stems], "stem string"), args.status, on)
    else:
        place = args.shortlist or cfg.paths["shortlist"]
        fs, p = hadoop_path(spark, place)
        if not fs.exists(p):
            raise FileNotFoundError(place)
        text = spark.read.text(place, wholetext=True).select(F.lit(place).alias("doc_id"), F.col("value").alias("text"))
        ledger, pending, lacking = review.sync_ledger(ledger, pending, text, rows, on)
    sinks.write_text(spark, path, exports.ledger_json(ledger, pending), True)
    lacking.show(1000, False)
    return 0


def _verify(spark: SparkSession, args: argparse.Namespace) -> int:
    said = markdown.as_turns(markdown.read(spark, args.transcripts)) if args.transcripts else turns.linearized(exports.read(spark, args.export))
    results = stored(verify.check(markdown.read(spark, args.source), said))
    verify.summary(results).show()
    return int(not verify.failures(results).isEmpty())


def main(argv: list[str] | None = None) -> int:
    args = _arguments().parse_args(argv)
    cfg = config.load(args.config)
    if getattr(args, "top", None):
        cfg = config.replace(cfg, top=args.top)
    if args.command == "paths":
        print(json.dumps({"config": args.config, "owner": cfg.owner, "link_style": cfg.link_style, **cfg.paths}, indent=2))
        return 0
    spark = session()
    if cfg.timezone:
        spark.conf.set("spark.sql.session.timeZone", cfg.timezone)
    with scratch(spark):
        if args.command == "check":
            conversations = exports.read(spark, args.source)
            verdict = profile.verdict(conversations).first()
            profile.messages(conversations).show(100, False)
            print(verdict["error"] or "ok")
            return int(bool(verdict["error"]))
        if args.command == "stats":
            conversations = exports.read(spark, args.source)
            said = turns.linearized(catalog.first(conversations, args.limit) if args.limit else conversations)
            authorship.calibration(authorship.labelled(said, cfg)).show()
            return 0
        if args.command == "verify":
            return _verify(spark, args)
        if args.command == "promote":
            return _promote(spark, args, cfg)
        if args.command == "ledger":
            return _ledger(spark, args, cfg)
        rows, said = _index(spark, args, cfg)
        if args.command in ("parse", "run"):
            _parse(rows, said, args)
        if args.command in ("voice", "run"):
            _voice(spark, rows, said, args, cfg)
        if args.command in ("rank", "run"):
            _rank(spark, rows, args, cfg)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
