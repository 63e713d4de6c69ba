"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A source's documents stand in a hashed order and their words are cut into blocks of a fixed number. The words a source
shall give make its quota: full passes over its blocks and, in a last pass, as many blocks as are left, the final one cut
to the word. The quotas of all sources are split in two again and again until every output shard has its own: how many
blocks of each source go to the left half is one draw from the multivariate hypergeometric distribution, as if the blocks
had been shuffled and dealt. Which blocks these are follows from a keyed permutation of each source's blocks: shards take
disjoint stretches of it. Inside a shard, pieces are put in the order of a hash.

All of it is Column expressions. Only totals and the scalar of the weights pass through the driver; one row per tree node
holds a quota for every source.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import unused
from ledgerloom.llm.feistel import hash60, permute
from ledgerloom.operators.keys import assign_keys
from ledgerloom.session import cut

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 1024
SHARDS = 16
CAP = 3
BUCKET_ROWS = 64  # documents whose running sum is one window, and buckets whose running sum is one


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _log_factorial(n: Column) -> Column:
    """Stirling's series, eight places up."""
    z = n.cast("double") + 9
    near = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z)
    product = F.lit(1.0)
    for k in range(1, 9):
        product = product * (n + k)
    return near - F.log(product)


def hypergeometric(u: Column, good: Column, bad: Column, draws: Column) -> Column:
    """How many of ``draws`` from ``good + bad`` are good, by inversion of the uniform number u.

    The search covers the support within eight standard deviations of the mode; what lies beyond weighs less than 1e-14.
    """
    total = good + bad
    mode = F.floor((draws + 1.0) * (good + 1.0) / (total + 2.0)).cast("long")
    spread = F.sqrt(draws * (good / F.greatest(total, F.lit(1))) * (bad / F.greatest(total, F.lit(1))))
    reach = F.ceil(8 * spread + 8).cast("long")
    low, high = F.greatest(F.lit(0).cast("long"), draws - bad), F.least(good, draws)
    first, last = F.greatest(low, F.least(mode - reach, high)), F.least(high, F.greatest(mode + reach, low))

    def choose(n: Column, k: Column) -> Column:
        return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)

    def search(x: Column) -> Column:
        start = F.exp(choose(good, x["first"]) + choose(bad, draws - x["first"]) - choose(total, draws))
        state = F.struct(u.alias("left"), start.alias("p"), x["first"].alias("pick"))

        def step(s: Column, k: Column) -> Column:
            ratio = (good - k) * 1.0 * (draws - k) / ((k + 1.0) * (bad - draws + k + 1))
            return F.when(
                s["left"] > 0, F.struct((s["left"] - s["p"]).alias("left"), (s["p"] * F.when(k < x["last"], ratio).otherwise(0.0)).alias("p"), k.alias("pick"))
            ).otherwise(s)

        return F.aggregate(F.sequence(x["first"], x["last"]), state, step, lambda s: s["pick"])

    return F.transform(F.array(F.struct(first.alias("first"), last.alias("last"))), search)[0]


def split_quotas(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """``rank, shard, draws``: every source's quota (``rank, draws``) dealt to the shards, which get equally many, give or take one."""
    every = F.sort_array(F.collect_list(F.struct("rank", "draws")))
    nodes = quotas.agg(every.alias("quotas")).select(F.lit(0).alias("low"), F.lit(shards).alias("high"), "quotas")
    wide = 1
    while wide < shards:
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda n, q: n + q["draws"])
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        # Shards below k hold floor(total * k / width) of a node's draws.
        take = F.expr("total * (middle - low) div (high - low)")
        node = F.concat_ws("-", F.lit(seed), "low", "high")

        def deal(s: Column, q: Column) -> Column:
            u = hash60(node, q["rank"], F.lit(0)) / float(1 << 60)
            x = F.when(q["draws"] == 0, F.lit(0).cast("long")).otherwise(hypergeometric(u, q["draws"], s["rest"] - q["draws"], s["need"]))
            one = F.transform(F.array(x), lambda v: F.struct(
                (s["rest"] - q["draws"]).alias("rest"), (s["need"] - v).alias("need"),
                F.concat(s["out"], F.array(F.struct(q["rank"].alias("rank"), v.alias("draws")))).alias("out"),
            ))
            return one[0]

        none = F.slice("quotas", 1, 0)
        start = F.struct(F.col("total").alias("rest"), F.col("take").alias("need"), none.alias("out"))
        split = nodes.withColumn("total", total).withColumn("middle", middle).withColumn("take", take.cast("long"))
        split = split.withColumn("left", F.when(F.col("middle") > F.col("low"), F.aggregate("quotas", start, deal, lambda s: s["out"])).otherwise(none))
        right = F.zip_with("quotas", "left", lambda q, x: F.struct(q["rank"].alias("rank"), (q["draws"] - x["draws"]).alias("draws")))
        halves = F.when(F.col("high") - F.col("low") == 1, F.array(F.struct("low", "high", "quotas"))).otherwise(F.array(
            F.struct("low", F.col("middle").alias("high"), F.col("left").alias("quotas")),
            F.struct(F.col("middle").alias("low"), "high", right.alias("quotas")),
        ))
        nodes = split.select(F.explode(halves).alias("half")).select("half.*")
        wide *= 2
    return nodes.select(F.col("low").alias("shard"), F.explode("quotas").alias("q")).select("q.rank", "shard", "q.draws")


def targets(sources: DataFrame, cap: int) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``: shares by weight of all sizes, none above cap times its own size."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, -1
    while True:
        full = F.col("source_size") * cap <= F.col("weight") * F.lit(level)
        n, given, weights = sources.agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("source_size") * cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if n == before or not weights:
            break
        before, level = n, (total - given) / weights
    return sources.withColumn("target", F.least(F.col("source_size") * cap, F.col("weight") * F.lit(level)).cast("double"))


def plan_sources(rows: DataFrame, cap: int, block_words: int) -> DataFrame:
    """One row per source: sizes, target, full passes over its blocks, and the words and blocks of the last pass."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    ordered = sizes.withColumn("last", F.col("source").isNull())
    ranked = assign_keys(ordered, "rank", ["last", "source"], first=0).withColumn("weight", F.col("rank") % 3 + 1)
    goals = targets(cut(ranked), cap)
    words = F.round("target").cast("long")
    size = F.greatest("source_size", F.lit(1))
    goals = goals.withColumn("blocks", F.expr(f"(source_size + {block_words - 1}) div {block_words}"))
    goals = goals.withColumn("passes", F.floor(words / size).cast("long"))
    goals = goals.withColumn("rest", words - F.col("passes") * F.col("source_size"))
    return cut(goals.withColumn("part", F.expr(f"(rest + {block_words - 1}) div {block_words}")).drop("last"))


def deal_quotas(goals: DataFrame, shards: int, seed: str) -> DataFrame:
    """``goals`` with every source's quota of blocks, and where each shard's stretch of the source's draws ends."""
    goals = cut(goals.withColumn("draws", F.col("passes") * F.col("blocks") + F.col("part")))
    dealt = split_quotas(goals.select("rank", "draws"), shards, seed)
    stretches = dealt.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("shard", "draws"))).alias("given"))
    ends = F.transform(F.sequence(F.lit(1), F.size("given")), lambda k: F.aggregate(
        F.slice("given", F.lit(1), k), F.lit(0).cast("long"), lambda n, g: n + g["draws"]))
    return cut(goals.join(stretches.select("rank", ends.alias("ends")), "rank"))


def _running(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))


def _ahead(fine: DataFrame, place: str, width: int) -> DataFrame:
    """``fine`` (rank, place, words) with ``ahead``: the source's words at smaller places.

    Windows run over the places of a group, ``width`` at most, and a source's groups.
    """
    fine = fine.withColumn("group", F.expr(f"{place} div {width}"))
    coarse = _running(fine.groupBy("rank", "group").agg(F.sum("words").alias("words")), ["rank"], ["group"], "words", "earlier")
    fine = _running(fine, ["rank", "group"], [place], "words", "before").join(coarse.drop("words"), ["rank", "group"])
    return fine.withColumn("ahead", F.col("before") + F.col("earlier")).drop("group", "before", "earlier")


def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's plan and ``start``: the words of the source that stand before them in its hashed order.

    The order is by hash bucket and hash. Windows run over a bucket's rows, a group's buckets and a source's groups, so
    that none holds a source as a whole.
    """
    buckets = F.expr(f"(source_rows + {BUCKET_ROWS - 1}) div {BUCKET_ROWS}")
    plan = sources.withColumnRenamed("source", "_source")
    rows = rows.join(plan, rows["source"].eqNullSafe(plan["_source"])).drop("_source")
    rows = rows.withColumn("bucket", F.pmod("hash", buckets))
    fine = _ahead(rows.groupBy("rank", "bucket").agg(F.sum("size").alias("words")), "bucket", BUCKET_ROWS).drop("words")
    rows = _running(rows, ["rank", "bucket"], ["hash", "doc_id", "size"], "size", "inside")
    return rows.join(fine, ["rank", "bucket"]).withColumn("start", F.col("ahead") + F.col("inside"))


def _first_block(block_words: int) -> Column:
    return F.least(F.floor(F.col("start") / block_words).cast("long"), F.col("blocks") - 1)


def _place_in_pass(block: Column, turn: Column, seed: str) -> Column:
    """Which draw of a pass a block is. The last block, which may be short, is the last of every pass."""
    key = F.concat_ws("-", F.lit(seed), "rank", turn)
    return F.when(block == F.col("blocks") - 1, block).otherwise(permute(block, F.col("blocks") - 1, key))


def _edges(placed: DataFrame, block_words: int, seed: str) -> DataFrame:
    """``rank, part, edge_ahead, edge_head``: where the last pass over whole documents ends.

    ``part`` blocks are drawn until the documents that begin in them hold the words that are left. The final one has
    ``edge_ahead`` words of the pass before it and ``edge_head`` words of the source before its first document.
    """
    plan = ["rank", "passes", "blocks", "rest"]
    blocks = placed.where("rest > 0").groupBy(*plan, _first_block(block_words).alias("block"))
    blocks = blocks.agg(F.sum("size").alias("words"), F.min("start").alias("edge_head"))
    blocks = blocks.withColumn("place", _place_in_pass(F.col("block"), F.col("passes"), seed))
    edge = _ahead(blocks, "place", BUCKET_ROWS * BUCKET_ROWS).where("ahead < rest and rest <= ahead + words")
    return edge.select("rank", (F.col("place") + 1).alias("part"), F.col("ahead").alias("edge_ahead"), "edge_head")


def _pieces(block_words: int, seed: str, whole: bool) -> Column:
    """The pieces of a document that the mix takes: shard, order in it, pass, first word in the document and words."""
    start, size, blocks = F.col("start"), F.col("size"), F.col("blocks")
    first = _first_block(block_words)
    last = first if whole else F.floor((start + size - 1) / block_words).cast("long")

    def draw(block: Column, turn: Column) -> Column:
        return turn * blocks + _place_in_pass(block, turn, seed)

    def piece(block: Column, turn: Column, number: Column) -> Column:
        final = (number == F.col("draws") - 1) & (F.col("part") > 0)
        # The final draw of a source is cut to the words that are left.
        end = block * block_words + F.when(final, F.col("rest") - (F.col("part") - 1) * block_words).otherwise(block_words)
        begin = F.greatest(start, block * block_words)
        if whole:
            # Documents of the final draw are taken as long as that brings the sum nearer to the words that are left.
            words, before = size, F.col("edge_ahead") + start - F.col("edge_head")
            taken = ~final | (2 * before + size <= 2 * F.col("rest"))
        else:
            words = F.least(start + size, end) - begin
            taken = words > 0
        shard = F.size(F.filter("ends", lambda e: e <= number))
        return F.when((number < F.col("draws")) & taken, F.struct(
            shard.alias("shard"), hash60(F.lit(seed + "-order"), F.col("rank"), number).alias("order"), turn.alias("pass"),
            (F.lit(0).cast("long") if whole else begin - start).alias("first"), words.alias("words"),
        ))

    def of_block(block: Column) -> Column:
        numbered = lambda turn: F.transform(F.array(draw(block, turn)), lambda n: piece(block, turn, n))[0]
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes")), numbered)

    every = F.flatten(F.transform(F.sequence(first, last), of_block))
    nothing = (blocks == 0) if whole else (size == 0)
    return F.when(nothing, None).otherwise(F.filter(every, lambda p: p.isNotNull()))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", cap: int = CAP,
        block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: str = "mix", whole: bool = False) -> DataFrame:
    """``doc_id, source, hash, size, source_size, target, taken, pieces`` for every document.

    ``size`` is the text's number of words (null: 0). Sources by code point, null last, weigh 1, 2, 3 and so on again. They
    share the words of all documents by weight, but no source gives more than ``cap`` times its words; what is left over is
    shared out again. ``pieces`` says what the mix takes of a document: shard, order in the shard, pass, first word and
    number of words; ``taken`` is the sum of their words, at most ``cap`` times the size, and a source's add up to its
    rounded target. With ``whole``, blocks take the documents that begin in them, whole, and the last pass counts their
    words: a source's sum misses its rounded target by at most half of the one document at which the words run out. Empty
    documents then have pieces of no words.

    Reruns agree, however the rows are partitioned. Rows that agree in id and text are dealt in any order among themselves.
    A source without words gives nothing. An empty table gives an empty result; other columns are not looked at.
    """
    body = F.col(text)
    rows = cut(docs.select(
        F.col(id).alias("doc_id"), F.col(source).alias("source"), word_count(body).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id), body).alias("hash"),
    ))
    goals = plan_sources(rows, cap, block_words)
    if whole:
        placed = cut(_placed(rows, goals.drop("part")))
        edges = _edges(placed, block_words, seed)
        goals = goals.drop("part").join(edges, "rank", "left").withColumn("part", F.coalesce("part", F.lit(0)))
        dealt = deal_quotas(goals, shards, seed).select("rank", "part", "edge_ahead", "edge_head", "draws", "ends")
        placed = placed.join(dealt, "rank")
    else:
        placed = _placed(rows, deal_quotas(goals, shards, seed))
    placed = placed.withColumn("pieces", _pieces(block_words, seed, whole))
    taken = F.coalesce(F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["words"]), F.lit(0).cast("long"))
    return placed.select("doc_id", "source", "hash", "size", "source_size", "target", taken.alias("taken"), "pieces")


def deal(mixed: DataFrame) -> DataFrame:
    """One row per piece, sorted by shard and the shuffled order inside it: the mix as it is written out."""
    rows = mixed.select("doc_id", "source", F.explode("pieces").alias("p")).select("p.shard", "p.order", "doc_id", "source", "p.pass", "p.first", "p.words")
    return rows.repartitionByRange("shard", "order").sortWithinPartitions("shard", "order", "doc_id", "first")


def mix_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix") -> DataFrame:
    """``docs`` as whole documents in mix proportions: a row comes as often as the mix takes it, not at all or up to ``CAP`` times.

    The copies stand by shard and by their block's shuffled order in it; the documents of a block stay together. Null sources are
    one source, a null text has no words. Rows that agree in id and text share what the mix takes of them. An empty table gives
    an empty result. Columns of any name come back as they are.
    """
    row_hash, place, shard, order = unused(docs, "row_hash", "place", "shard", "order")
    copy_id, copy_hash, copy_places = unused(docs, "copy_id", "copy_hash", "copy_places")
    mixed = mix(docs, id, text, source, seed=seed, whole=True)
    places = F.transform("pieces", lambda p: F.struct(p["shard"].alias("shard"), p["order"].alias("order")))
    copies = mixed.where(F.size("pieces") > 0).select("doc_id", "hash", F.struct(F.size("pieces"), places.alias("places")).alias("taken"))
    copies = copies.groupBy("doc_id", "hash").agg(F.max("taken").alias("taken"))
    copies = cut(copies.select(F.col("doc_id").alias(copy_id), F.col("hash").alias(copy_hash), F.col("taken.places").alias(copy_places)))
    keyed = docs.withColumn(row_hash, F.xxhash64(F.lit(seed), F.col(id), F.col(text)))
    same = keyed[row_hash].eqNullSafe(copies[copy_hash]) & keyed[id].eqNullSafe(copies[copy_id])
    dealt = keyed.join(copies, same).select(*[keyed[c] for c in docs.columns], row_hash, F.explode(copy_places).alias(place))
    dealt = dealt.select(*docs.columns, row_hash, F.col(f"{place}.shard").alias(shard), F.col(f"{place}.order").alias(order))
    return dealt.repartitionByRange(shard, order).sortWithinPartitions(shard, order, row_hash).select(*docs.columns)
