"""Jobs for spark-submit: ``python -m postgrove <job> ...``."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession

from postgrove.dimensions import CORRECTED_BOXES, POLARITY_WORDS, REGION_BOXES, STOP_WORDS
from postgrove.operators.language import LanguageModel
from postgrove.operators.lexicon import learn_lexicon
from postgrove.plans import enrich, ingest, reports, training
from postgrove.plans.increments import ReportCounts
from postgrove.plans.models import ModelFolder
from postgrove.schemas import ANSWERS, CLEAN_POST, CONTRACTS, ENRICHED_POST, RAW_POST
from postgrove.session import build_session
from postgrove.sources import files
from postgrove.sources.keyed import KeyedTable
from postgrove.sources.messages import KeyedSink, Sink, read_messages
from postgrove.streaming.scoring import each_once, keep_running, start_scoring


def raw_posts(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Raw CSV or Parquet files, dealt out where they are fewer than the cores."""
    if args.input_format == "parquet":
        raw = files.with_file_path(files.read_parquet(spark, args.input, RAW_POST), "filename")
    else:
        raw = files.read_csv(
            spark, args.input, RAW_POST, multi_line=args.multi_line, file_column="filename"
        )
    return files.spread(raw)


def placing(args: argparse.Namespace) -> dict:
    """How posts are given a region."""
    boxes = CORRECTED_BOXES if args.boxes == "corrected" else REGION_BOXES
    return {"boxes": boxes, "tie_break": args.tie_break}


def clean(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return files.read_parquet(spark, args.input, CLEAN_POST)


def enriched(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return files.read_parquet(spark, args.input, ENRICHED_POST)


def job_ingest(spark, args):
    if args.with_rejected:
        print(ingest.write_judged(raw_posts(spark, args), args.output, **placing(args)))
        return
    files.write_parquet(ingest.clean_posts(raw_posts(spark, args), **placing(args)), args.output)


def job_train_language(spark, args):
    """Learn languages from a Parquet table of texts with a language code."""
    labelled = files.read_parquet(spark, args.input)
    LanguageModel.fit(labelled, args.text, args.language).save(args.output)


def job_learn_lexicon(spark, args):
    """Spread the polarity of seed words, a Parquet table of word and polarity, over the words of texts."""
    given = POLARITY_WORDS
    if args.seeds:
        seeds = files.read_parquet(spark, args.seeds).select("word", "polarity").toArrow()
        given = dict(zip(seeds["word"].to_pylist(), seeds["polarity"].to_pylist()))
    files.write_parquet(learn_lexicon(files.read_parquet(spark, args.input), given, args.text), args.output)


def job_enrich(spark, args):
    model = LanguageModel.load(spark, args.model)
    posts = files.spread(clean(spark, args))
    lexicon = POLARITY_WORDS
    if args.lexicon:
        lexicon = spark.read.schema("word string, polarity double").load(
            args.lexicon, format=args.lexicon_format, header=True
        )
    files.write_parquet(enrich.enriched_posts(posts, model, lexicon), args.output)


def cumulative(rows: DataFrame, args: argparse.Namespace) -> DataFrame:
    return reports.cumulative_by_language(rows, args.start, args.end)


def word_list(raw: DataFrame, args: argparse.Namespace) -> DataFrame:
    stop_words = STOP_WORDS
    if args.stop_words:
        # A list a person keeps, one word per line.
        stop_words = [row.value for row in raw.sparkSession.read.text(args.stop_words).collect()]
    return reports.top_words(
        ingest.word_posts(raw, **placing(args)), str(uuid.uuid4()), args.k,
        stop_words=stop_words, full_mentions=args.full_mentions,
    )


REPORTS = {
    "hour": (clean, lambda rows, args: reports.hourly_counts(rows)),
    "state": (clean, lambda rows, args: reports.state_counts(rows)),
    "language": (enriched, lambda rows, args: reports.language_counts(rows)),
    "state_analyze": (enriched, lambda rows, args: reports.state_sentiment_counts(rows)),
    "date_cumulative": (enriched, cumulative),
    "word_list": (raw_posts, word_list),
}


def job_report(spark, args):
    """One result table, upserted by its key, or appended to a store by its connector."""
    read, report = REPORTS[args.table]
    result = report(read(spark, args), args)
    if args.format:
        files.append_table(result, args.format, **options(args.option))
    else:
        KeyedTable(spark, args.output, CONTRACTS[args.table]).upsert(result, args.version)


def job_follow(spark, args):
    """Keep the counts behind the result tables up to date with a folder that posts are added to."""
    schema = ENRICHED_POST if args.kind == "enriched" else CLEAN_POST
    counts = ReportCounts(spark, args.output)
    follow = counts.follow_enriched if args.kind == "enriched" else counts.follow_clean
    posts = spark.readStream.schema(schema).parquet(args.input)
    follow(posts, args.checkpoint, {"availableNow": True} if args.once else None).awaitTermination()


def job_compact(spark, args):
    """Fold the versions of a result table into a new base."""
    table = KeyedTable(spark, args.output, CONTRACTS[args.table])
    table.compact()
    if args.vacuum_hours is not None:
        table.vacuum(args.vacuum_hours * 3600)


def job_train(spark, args):
    features = training.POST_FEATURES if args.with_state else training.REQUEST_FEATURES
    rows = enriched(spark, args).select(*ENRICHED_POST.fieldNames())
    first, rest = training.split_rows(rows, rows.columns, args.fraction, args.seed)
    made = training.train(first, features, seed=args.seed)
    skipped = rows.where(training.incomplete(features)).count()
    training.evaluate(made.model, {"train": first, "validation": rest}).show()
    print(f"rows skipped for a missing number: {skipped}")
    training.save_model(made.model, args.output)


def job_score(spark, args):
    rows = files.read_parquet(spark, args.input)
    files.write_parquet(training.score(training.load_model(args.model), rows), args.output)


def job_serve(spark, args):
    """Score request messages until stopped."""
    source = options(args.source_option)
    if args.once_within:
        messages = each_once(read_messages(spark, args.source, "arrived", **source), "arrived", args.once_within)
    else:
        messages = read_messages(spark, args.source, **source)
    if args.sink == "keyed":
        answers = KeyedSink(KeyedTable(spark, args.answers, ANSWERS))
    else:
        answers = Sink(args.sink, args.answers, options(args.sink_option))
    keep_running(lambda: start_scoring(
        messages,
        ModelFolder(spark, args.model) if args.versions else training.load_model(args.model),
        answers,
        Sink("text", args.dead_letters),
        args.checkpoint,
        {"availableNow": True} if args.once else None,
    ), args.restarts)


def options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="postgrove")
    jobs = top.add_subparsers(required=True)

    def job(name, run, *required):
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for flag in required:
            sub.add_argument(f"--{flag}", required=True)
        return sub

    def raw(sub):
        sub.add_argument("--input-format", choices=("csv", "parquet"), default="csv")
        sub.add_argument("--multi-line", action=argparse.BooleanOptionalAction, default=True,
                         help="quoted text may hold line ends; a file is then one task")
        sub.add_argument("--boxes", choices=("listed", "corrected"), default="listed")
        sub.add_argument("--tie-break", choices=("order", "smallest_area"), default="order")

    sub = job("ingest", job_ingest, "input", "output")
    raw(sub)
    sub.add_argument("--with-rejected", action="store_true",
                     help="write all lines in folders verdict=..., clean posts in verdict=kept")
    sub = job("train-language", job_train_language, "input", "output")
    sub.add_argument("--text", default="text")
    sub.add_argument("--language", default="lang")
    sub = job("learn-lexicon", job_learn_lexicon, "input", "output")
    sub.add_argument("--seeds", help="by default the library's own list")
    sub.add_argument("--text", default="tweet")
    sub = job("enrich", job_enrich, "input", "model", "output")
    sub.add_argument("--lexicon", help="a table of word and polarity")
    sub.add_argument("--lexicon-format", default="parquet")
    sub = job("report", job_report, "input")
    sub.add_argument("table", choices=REPORTS)
    sub.add_argument("--output")
    sub.add_argument("--version", type=int, help="to repeat one; by default the next")
    raw(sub)
    sub.add_argument("--start", default=reports.FIRST_DAY, help="first day of date_cumulative")
    sub.add_argument("--end", default=reports.LAST_DAY)
    sub.add_argument("--k", type=int, default=10, help="words per group of word_list")
    sub.add_argument("--full-mentions", action="store_true")
    sub.add_argument("--stop-words", help="a text file, one word per line")
    sub.add_argument("--format", help="append through this connector instead")
    sub.add_argument("--option", action="append", default=[], help="key=value of the connector")
    sub = job("train", job_train, "input", "output")
    sub.add_argument("--with-state", action="store_true")
    sub.add_argument("--fraction", type=float, default=0.75)
    sub.add_argument("--seed", type=int, required=True)
    sub = job("compact", job_compact, "output")
    sub.add_argument("table", choices=REPORTS)
    sub.add_argument("--vacuum-hours", type=float, help="also remove folders not in use for so long")
    sub = job("follow", job_follow, "input", "output", "checkpoint")
    sub.add_argument("kind", choices=("clean", "enriched"))
    sub.add_argument("--once", action="store_true", help="stop when all posts so far are counted")
    job("score", job_score, "input", "model", "output")
    sub = job("serve", job_serve, "model", "checkpoint", "dead-letters")
    sub.add_argument("--source", default="kafka")
    sub.add_argument("--source-option", action="append", default=[])
    sub.add_argument("--sink", default="kafka", help="a format, or keyed for a table with one answer per uuid")
    sub.add_argument("--versions", action="store_true", help="the model is a folder of versions, the newest in use")
    sub.add_argument("--restarts", type=int, default=5, help="starts after failures in a row")
    sub.add_argument("--once-within", help="drop requests whose uuid came before within this time, as 1 hour")
    sub.add_argument("--answers", help="folder of answers, for file sinks")
    sub.add_argument("--sink-option", action="append", default=[])
    sub.add_argument("--once", action="store_true", help="stop when all pending are answered")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session("postgrove"), args)


if __name__ == "__main__":
    main()
