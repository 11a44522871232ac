"""Schema-driven synthetic records as column expressions over a sequence.

A schema becomes one ``select`` with a prebuilt column list, and nothing is cached in workers: the generator
is a plan. Records of several hundred fields are beyond Spark's compiler; ``vectors.py`` makes them, the same
values, in one pass over Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions.draws import LANES, Draws, fixed_letters, fixed_number, letters_from, with_lanes
from millrace.session import cut_lineage
from millrace.sources import vectors

# Fixed value: share of string draws, in ten-thousandths, that are fresh (P(gaussian < 0.001)).
FRESH_PER_TEN_THOUSAND = 5004
NOW = "_now"


@dataclass(frozen=True)
class GeneratorOptions:
    """Defaults: strings of 20 to 79 letters, collections of 1 to 19 elements."""

    min_chars: int = 20
    max_chars: int = 80
    max_collection: int = 20
    complete: bool = True
    skewed_fields: tuple[str, ...] = ()
    skew_degree: int = 0
    skew_buckets: int = 1000
    empty_arrays: bool = False
    seed: int = 42
    now: Column | None = field(default=None, compare=False)

    def __post_init__(self):
        if not 0 < self.min_chars < self.max_chars:
            raise ValueError("string lengths need 0 < min_chars < max_chars")
        if self.max_collection < 1:
            raise ValueError("max_collection must be at least 1")
        named = tuple(name.strip() for name in self.skewed_fields if name.strip())
        object.__setattr__(self, "skewed_fields", named)

    @staticmethod
    def for_format(name: str, **kwargs) -> GeneratorOptions:
        """Options of one of the three message formats; JSON arrays may be empty."""
        if name.upper() not in ("AVRO", "THRIFT", "JSON"):
            raise ValueError(f"unknown format: {name}")
        return GeneratorOptions(empty_arrays=name.upper() == "JSON", **kwargs)

POSITIONS = 2**31 - 1  # positions in nested collections wrap here


class FieldBuilder:
    """Turns a data type and a field path into Spark SQL expression text."""

    def __init__(self, options: GeneratorOptions):
        self.opt = options
        self.draws = Draws(options.seed)
        self._depth = 0

    def record(self, schema: T.StructType) -> list[Column]:
        return [F.expr(self.field(f, f.name, None, self.opt.complete)).alias(f.name) for f in schema.fields]

    def struct(self, schema: T.StructType, path: str = "", pos: str | None = None, whole: bool | None = None) -> str:
        whole = self.opt.complete if whole is None else whole
        members = (f"'{f.name}', {self.field(f, path + f.name, pos, whole)}" for f in schema.fields)
        return f"named_struct({', '.join(members)})"

    def field(self, spec: T.StructField, path: str, pos: str | None, whole: bool) -> str:
        value = self.value(spec.dataType, spec.metadata, spec.name, path, pos, whole)
        if whole or not spec.nullable or isinstance(spec.dataType, T.BinaryType):
            return value
        present = self.draws.boolean(path + "?", pos)
        if isinstance(spec.dataType, (T.ArrayType, T.MapType)):
            empty = "array()" if isinstance(spec.dataType, T.ArrayType) else "map()"
            return f"IF({present}, {value}, CAST({empty} AS {spec.dataType.simpleString()}))"
        return f"IF({present}, {value}, NULL)"

    def value(self, kind: T.DataType, meta: dict, name: str, path: str, pos: str | None, whole: bool) -> str:
        draws = self.draws
        if isinstance(kind, T.StructType):
            return self.struct(kind, path + ".", pos, whole)
        if isinstance(kind, T.ArrayType):
            return self.array(kind, meta, name, path, pos)
        if isinstance(kind, T.MapType):
            return self.map(kind, name, path, pos)
        if isinstance(kind, T.StringType):
            return self.text(meta, name, path, pos)
        if isinstance(kind, T.BinaryType):
            return f"CAST({self.text(meta, name, path, pos)} AS BINARY)"
        if isinstance(kind, T.TimestampType):
            micros = draws.below(1_000_000, path + "+", pos)
            return f"timestamp_micros({draws.number(path, pos)} * 1000000 + {micros})"
        if isinstance(kind, T.FloatType):
            return f"CAST({draws.fraction(path, pos)} AS FLOAT)"
        scalar = {
            T.BooleanType: draws.boolean,
            T.ByteType: draws.byte,
            T.ShortType: draws.short,
            T.IntegerType: draws.integer,
            T.LongType: draws.long,
            T.DoubleType: draws.fraction,
        }.get(type(kind))
        if scalar is None:
            raise ValueError(f"no generator for {kind.simpleString()} ({path})")
        return scalar(path, pos)

    def text(self, meta: dict, name: str, path: str, pos: str | None) -> str:
        opt, draws = self.opt, self.draws
        if meta.get("now"):
            return f"date_format({NOW}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
        symbols = meta.get("symbols")
        if symbols:
            domain = ", ".join("'" + s.replace("'", "\\'") + "'" for s in symbols)
            return f"element_at(array({domain}), CAST({draws.below(len(symbols), path, pos)} + 1 AS INT))"
        if name in opt.skewed_fields:
            return self.bucket_text(name, draws.skewed(opt.skew_buckets, opt.skew_degree, path + "^", pos))
        # One draw decides both: its low digits the repetition, the rest the length.
        drawn = draws.number(path + "*", pos)
        if pos is None:
            return self.drawn_text(drawn, name, path, pos)
        # Lambda bodies are interpreted: bind the draw once instead of repeating it.
        bound = self.variable()
        return f"element_at(transform(array({drawn}), {bound} -> {self.drawn_text(bound, name, path, pos)}), 1)"

    def drawn_text(self, drawn: str, name: str, path: str, pos: str | None) -> str:
        opt = self.opt
        length = f"({drawn} DIV 10000 % {opt.max_chars - opt.min_chars} + {opt.min_chars})"
        made = self.draws.letters(path, length, opt.max_chars - 1, pos)
        return f"IF({drawn} % 10000 < {FRESH_PER_TEN_THOUSAND}, {made}, '{repeated_text(opt, name)}')"

    def bucket_text(self, name: str, bucket: str) -> str:
        """The one string of a skew bucket: a function of field name and bucket only."""
        opt = self.opt
        shift = fixed_number(opt.seed, name, 1 << 20)
        length = f"(({bucket} * 7919 + {shift}) % {opt.max_chars - opt.min_chars} + {opt.min_chars})"
        return letters_from(f"concat('{opt.seed}|{name}|bucket|', CAST({bucket} AS STRING))", length, opt.max_chars - 1)

    def variable(self) -> str:
        self._depth += 1
        return f"_v{self._depth}"

    def numbers(self) -> str:
        longest = max(1, self.opt.max_collection - 1)
        return f"array({', '.join(str(i) for i in range(1, longest + 1))})"

    def positions(self, path: str, pos: str | None, smallest: int) -> str:
        """1..n with n in [smallest, max_collection); ``slice`` also yields an empty range."""
        drawn = self.draws.below(self.opt.max_collection, path + "%", pos)
        return f"slice({self.numbers()}, 1, CAST(greatest({drawn}, {smallest}) AS INT))"

    def array(self, kind: T.ArrayType, meta: dict, name: str, path: str, pos: str | None) -> str:
        i = self.variable()
        inner_meta = {k: v for k, v in meta.items() if k == "symbols"}
        element = self.value(kind.elementType, inner_meta, name, path + "[]", deeper(pos, i, self.opt.max_collection), True)
        positions = self.positions(path, pos, 0 if self.opt.empty_arrays else 1)
        made = f"transform({positions}, {i} -> {element})"
        return f"array_distinct({made})" if meta.get("unique") else made

    def map(self, kind: T.MapType, name: str, path: str, pos: str | None) -> str:
        """First value wins when a key repeats. A one-element ``transform`` binds the key list
        once instead of once per use."""
        i, keys, j, k, n = (self.variable() for _ in range(5))
        key = self.value(kind.keyType, {}, name, path + "{k}", deeper(pos, i, self.opt.max_collection), True)
        drawn = f"transform({self.positions(path, pos, 1)}, {i} -> {key})"
        first = (
            f"filter(slice({self.numbers()}, 1, size({keys})), "
            f"{j} -> array_position({keys}, element_at({keys}, {j})) = {j})"
        )
        item = self.value(kind.valueType, {}, name, path + "{v}", deeper(pos, n, self.opt.max_collection), True)
        made = f"map_from_arrays(transform({first}, {k} -> element_at({keys}, {k})), transform({first}, {n} -> {item}))"
        return f"element_at(transform(array({drawn}), {keys} -> {made}), 1)"


def deeper(pos: str | None, i: str, most: int) -> str:
    """Position inside nested collections of fewer than ``most`` elements.

    Positions stay below 2**31 as the draws need. They are unique while all levels together have fewer
    elements than that (three levels of 1,000, two of 40,000); beyond, they wrap at a prime, so repeats stay rare.
    """
    return f"CAST({i} AS BIGINT)" if pos is None else f"(({pos} * {max(1000, most)} + {i}) % {POSITIONS})"


def repeated_text(options: GeneratorOptions, name: str) -> str:
    """The one cached string of a field name."""
    span = options.max_chars - options.min_chars
    length = options.min_chars + fixed_number(options.seed, f"length of {name}", span)
    return fixed_letters(f"{options.seed}|{name}|repeated", length)


def generate(df: DataFrame, row_id: str, schema, options: GeneratorOptions | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per row of ``df``; ``row_id`` is the sequence number. Batch or streaming."""
    options, schema = options or GeneratorOptions(), schemas.resolve(schema)
    laned = _prepared(df, row_id, options)
    if vectors.suits(schema, options):
        return vectors.with_fields(laned, schema, options, keep).toDF(*keep, *schema.fieldNames())
    columns = FieldBuilder(options).record(schema)
    return laned.select(*[F.col(c) for c in keep], *columns)


def generate_then(df: DataFrame, row_id: str, schema, then: vectors.Made, shape: T.StructType, options: GeneratorOptions | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The records of :func:`generate`, handed to ``then`` in the task that makes them; what it returns, in ``shape``, are the rows.

    For wide records only (``vectors.suits``): nothing of them goes through Spark rows on the way.
    """
    options, schema = options or GeneratorOptions(), schemas.resolve(schema)
    if not vectors.suits(schema, options):
        raise ValueError("not a wide record")
    return vectors.with_fields(_prepared(df, row_id, options), schema, options, keep, then, shape)


def generate_records(df: DataFrame, row_id: str, schema, options: GeneratorOptions | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """As :func:`generate`, with the record in one struct column ``record``."""
    options, schema = options or GeneratorOptions(), schemas.resolve(schema)
    laned = _prepared(df, row_id, options)
    if vectors.suits(schema, options):
        made = vectors.with_fields(laned, schema, options, keep)
        whole = F.struct(*[F.col(f"_f{n}").alias(name) for n, name in enumerate(schema.fieldNames())])
        return made.select(*[F.col(f"_k{n}").alias(c) for n, c in enumerate(keep)], whole.alias("record"))
    record = F.expr(FieldBuilder(options).struct(schema))
    return laned.select(*[F.col(c) for c in keep], record.alias("record"))


def _prepared(df: DataFrame, row_id: str, options: GeneratorOptions) -> DataFrame:
    now = options.now if options.now is not None else F.current_timestamp()
    return with_lanes(df, row_id, options.seed).withColumn(NOW, now.cast("timestamp"))


# -- corpus ------------------------------------------------------------------------------------

SMALL_CORPUS_BYTES = 64 << 20


def number_rows(spark: SparkSession, corpus: DataFrame, order_by: tuple[str, ...] = ()) -> tuple[DataFrame, int, int]:
    """Add a dense ``corpus_index`` without a global sort task. Returns (frame, rows, bytes).

    Rows are range-partitioned (a seeded random last column keeps copies of one row apart),
    frozen by a reliable checkpoint, and numbered as partition offset + position. Only one row
    per partition travels through the offset window.
    """
    placed = corpus
    if order_by:
        keys = [F.col(c) for c in order_by]
        placed = corpus.repartitionByRange(*keys, F.rand(7)).sortWithinPartitions(*keys)
    tagged = placed.select("*", F.monotonically_increasing_id().alias("_mid"))
    frozen = cut_lineage(spark, tagged)
    part = F.shiftright("_mid", 33)
    size = F.octet_length(F.to_json(F.struct(*[c for c in corpus.columns])))
    counts = frozen.groupBy(part.alias("_part")).agg(
        F.count("*").alias("_rows"), F.sum(size).alias("_bytes")
    )
    rows = counts.orderBy("_part").collect()  # one row per partition
    offsets, total, weight = [], 0, 0
    for row in rows:
        offsets.append((row["_part"], total))
        total += row["_rows"]
        weight += row["_bytes"]
    starts = spark.createDataFrame(offsets, "_part bigint, _start bigint")
    numbered = (
        frozen.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn("corpus_index", F.col("_start") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_mid", "_part", "_start")
    )
    return numbered, total, weight


def sample_corpus(df: DataFrame, row_id: str, corpus: DataFrame, seed: int = 42, order_by: tuple[str, ...] = ()) -> DataFrame:
    """For each row of ``df`` emit one corpus row drawn uniformly with replacement.

    A corpus measured below 64 MiB is broadcast. A larger one is joined by shuffle; if it has
    few rows, each is replicated over several salts so no index becomes a hot key.
    """
    spark = df.sparkSession
    numbered, rows, weight = number_rows(spark, corpus, order_by)
    if rows == 0:
        raise ValueError("the corpus is empty")
    # Never null: saves the null filter that a join would evaluate the whole draw for.
    index = F.coalesce(F.expr(Draws(seed).below(rows, "corpus")), F.lit(0))
    drawn = with_lanes(df, row_id, seed).withColumn("corpus_index", index)
    if weight <= SMALL_CORPUS_BYTES:
        joined = drawn.join(F.broadcast(numbered), "corpus_index")
    else:
        salts = max(1, -(-4 * spark.sparkContext.defaultParallelism // rows))
        if salts > 1:
            numbered = numbered.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            drawn = drawn.withColumn("_salt", F.expr(Draws(seed).below(salts, "salt")).cast("int"))
            joined = drawn.join(numbered, ["corpus_index", "_salt"]).drop("_salt")
        else:
            joined = drawn.join(numbered, "corpus_index")
    return joined.drop(*LANES)


def refresh_timestamps(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Replace every nullable top-level timestamp by the generation time; other columns stay."""
    now = now if now is not None else F.current_timestamp()
    columns = []
    for spec in df.schema.fields:
        if isinstance(spec.dataType, (T.TimestampType, T.TimestampNTZType)) and spec.nullable:
            columns.append(now.cast(spec.dataType).alias(spec.name))
        else:
            columns.append(F.col(spec.name))
    return df.select(*columns)
