"""Small helpers shared by the text operators: reading, checkpoints, literals."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: space and the bytes 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Writes df into the shared checkpoint folder; later plans start from those files.

    The folder is what ``spark.checkpoint.dir`` names; without it one is made, but only where all of Spark runs on this
    machine.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    out = df.checkpoint(eager=True)
    if (made := _SCRATCH.get()) is not None:
        made.append(out)
    return out


_SCRATCH: ContextVar[list[DataFrame] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Checkpoints made inside are deleted at the end, but for those that the yielded function is given.

    What is kept, or computed inside, must not read the others any more: it is a checkpoint itself, or values on the driver.
    """
    made, kept = [], []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    before = _SCRATCH.set(made)
    try:
        yield keep
    finally:
        _SCRATCH.reset(before)
        for df in made:
            if all(df is not k for k in kept):
                forget(df)
        if (outer := _SCRATCH.get()) is not None:
            outer.extend(kept)


def forget(df: DataFrame) -> None:
    """Deletes the files of a checkpoint that nothing reads any more."""
    spark, files = df.sparkSession, df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if files.isDefined():
        where = spark._jvm.org.apache.hadoop.fs.Path(files.get())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Frames built inside lose their shuffle files as soon as an action on them ends; a lost one is made anew.

    For steps that end in checkpoints or results: otherwise all their shuffles stay on disk until the driver's JVM collects.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the session names, or a new one if its master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or tempfile.mkdtemp(prefix="checkpoint-")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names, each with underscores in front until df has no such column in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def any_names(operator):
    """An operator on a DataFrame that takes columns of any name: those with dots or backticks have plain names while it runs."""

    @wraps(operator)
    def run(*args, **named):
        at = next(k for k, x in enumerate(args) if isinstance(x, DataFrame))
        df = args[at]
        odd = [c for c in df.columns if "." in c or "`" in c]
        if not odd:
            return operator(*args, **named)
        plain = dict(zip(odd, fresh(df, *[f"_named_{k}" for k in range(len(odd))])))
        call = lambda x: plain.get(x, x) if isinstance(x, str) else x
        args = [df.toDF(*[plain.get(c, c) for c in df.columns]) if k == at else call(x) for k, x in enumerate(args)]
        out, back = operator(*args, **{k: call(x) for k, x in named.items()}), {p: c for c, p in plain.items()}
        return out.toDF(*[back.get(c, c) for c in out.columns])

    return run


def text_of(df: DataFrame, name: str) -> Column:
    """A text column with nulls read as empty."""
    return F.coalesce(df[name], F.lit(""))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unit_uniform(*parts: Column, seed: int) -> Column:
    """A uniform number in [0, 1) from a hash of the parts; the same for equal parts on any cluster."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


#: Elements that one step of scanned() goes through at a time.
SCAN_BLOCK = 64


def scanned(values: Column, op, zero: int = 0) -> Column:
    """For each of some int values, op over all before it (zero for the first); op is associative, zero neutral.

    Lists grow by copying in Spark's aggregate(), so it runs over blocks, then over their results: the cost stays in
    proportion to the number of values. values is a column or a lambda's variable, not an expression.
    """
    none = F.array().cast("array<int>")
    start = F.struct(F.lit(zero).alias("now"), none.alias("list"))

    def grow(of):
        return lambda a, x: F.struct(op(a["now"], of(x)).alias("now"), F.concat(a["list"], F.array(a["now"])).alias("list"))

    def joined(blocks: Column) -> Column:
        before = F.aggregate(blocks, start, grow(lambda x: x["now"]), lambda a: a["list"])
        return F.flatten(F.zip_with(blocks, before, lambda b, x: F.transform(b["list"], lambda y: op(x, y))))

    starts = F.sequence(F.lit(1), F.size(values), F.lit(SCAN_BLOCK))
    blocks = F.transform(starts, lambda k: F.aggregate(F.slice(values, k, F.lit(SCAN_BLOCK)), start, grow(lambda x: x)))
    return F.when(F.size(values) == 0, none).otherwise(let(blocks, joined))


#: Code points of a text in one of the chunks that pieces are read from.
PIECE_CHUNK = 1024


def chunked(text: Column) -> Column:
    """The text as a list of chunks, for piece(): reading a place deep in one long string would walk all that lies before."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE_CHUNK}}}"), F.lit(0))


def piece(chunks: Column, start: Column, n: Column) -> Column:
    """n code points from start (from 0) of a chunked text; empty for n of 0 or less."""
    first = F.floor(start / PIECE_CHUNK).cast("int")
    many = F.floor((start + n - 1) / PIECE_CHUNK).cast("int") - first + 1
    return F.when(n <= 0, "").otherwise(F.substring(F.array_join(F.slice(chunks, first + 1, many), ""), start - first * PIECE_CHUNK + 1, n))
