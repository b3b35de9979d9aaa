"""What records say about each other: revisits and their originals, hosts and their links, harvests and their totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.functions.binding import let
from warcloom.session import stored

SALTS = 32
HOT = 10_000


def originals(records: DataFrame, record: str = "id", refers_to: str = "refers_to") -> DataFrame:
    """For every revisit the record at the end of its chain: rows (id, original, hops, status).

    status is `original`, `missing` (the chain ends at a record that is not there, which is then `original`), or `cycle`
    (it never ends; no original). Pointers jump: each round replaces a pointer by its target's pointer, so a chain of n
    revisits takes log2(n) rounds. As long as some finite chain is unfinished a round finishes another one, so the first
    round that finishes none leaves cycles alone. Only unfinished pointers take part in a round. A record that comes more
    than once is one record; of several pointers the smallest counts.
    """
    pointer = F.nullif(F.col(refers_to), F.lit(""))
    ids = records.filter(F.col(record).isNotNull()).groupBy(F.col(record).alias("id")).agg(F.min(pointer).alias("at"))
    ids = stored(ids, "pointers")
    pointers = ids.filter("at IS NOT NULL").withColumn("hops", F.lit(1).cast("bigint"))
    known = ids.select(F.col("id").alias("at"), F.col("at").isNotNull().alias("goes_on"))
    state = stored(_joined_salted(pointers, known, "at").withColumn("goes_on", F.coalesce("goes_on", F.lit(False))), "pointers")
    done = state.filter("NOT goes_on").drop("goes_on")
    open_ = state.filter("goes_on").drop("goes_on")
    n_open = open_.count()
    while n_open:
        # where an open pointer leads: the end of a finished chain, or a further open one
        step = done.select(F.col("id").alias("at"), F.col("at").alias("next"), F.col("hops").alias("more"), F.lit(True).alias("ends"))
        step = step.unionByName(open_.select(F.col("id").alias("at"), F.col("at").alias("next"), F.col("hops").alias("more"), F.lit(False).alias("ends")))
        moved = _joined_salted(open_, step, "at").select("id", F.col("next").alias("at"), (F.col("hops") + F.col("more")).alias("hops"), "ends")
        moved = stored(moved, "pointers")
        left = moved.filter("NOT ends").count()
        done = done.unionByName(moved.filter("ends").drop("ends"))
        open_ = moved.filter("NOT ends").drop("ends")
        if left == n_open:
            break
        n_open = left
    ends = _joined_salted(done, ids.select(F.col("id").alias("at"), F.lit(True).alias("there")), "at")
    found = ends.select("id", F.col("at").alias("original"), "hops", F.when(F.col("there"), "original").otherwise("missing").alias("status"))
    cyclic = open_.select("id", F.lit(None).cast("string").alias("original"), F.lit(None).cast("bigint").alias("hops"), F.lit("cycle").alias("status"))
    return found.unionByName(cyclic)


def _joined_salted(rows: DataFrame, one_per_key: DataFrame, key: str) -> DataFrame:
    """Left join with a side that has one row per key. Rows of a hot key are dealt to SALTS tasks, its row goes to each.

    Hot keys have more than HOT rows and more than a 256th of all, so there are 255 at most; all others stay as they are.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNotNull())
    n = rows.count()
    hot = [r[key] for r in sizes.filter(F.col("n") > max(HOT, n // 256)).collect()] if n > HOT else []
    if not hot:
        return rows.join(one_per_key, key, "left")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    salted = rows.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).otherwise(0))
    copies = one_per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(is_hot, SALTS - 1).otherwise(0))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def host(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; null if it has none."""
    authority = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(F.lower(authority), "^[^@]*@", ""), ":[0-9]*$", "")
    return F.nullif(bare, F.lit(""))


def host_links(pages: DataFrame, url: str = "url", links: str = "links") -> DataFrame:
    """Links between different hosts as rows (source, target, n_links, n_pages).

    A page's links are counted per target within its row first, and pairs in every task before they are shuffled, so
    neither a page full of links nor a host that everybody links to is a task of its own.
    """
    def marked(targets: Column) -> Column:
        """Sorted targets, each with whether it is the page's first of its kind: linear in the links."""
        before = F.concat(F.array(F.lit(None).cast("string")), F.slice(targets, F.lit(1), F.greatest(F.size(targets) - 1, F.lit(0))))
        return F.zip_with(targets, F.slice(before, F.lit(1), F.size(targets)), lambda t, b: F.struct(t.alias("target"), (~t.eqNullSafe(b)).alias("first")))

    targets = F.array_sort(F.filter(F.transform(links, host), lambda h: h.isNotNull()))
    rows = pages.select(host(F.col(url)).alias("source"), F.explode(let(targets, marked)).alias("t")).select("source", "t.*")
    apart = rows.filter("source <> target")
    return apart.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n_links"), F.count_if("first").alias("n_pages"))


def host_degrees(links: DataFrame) -> DataFrame:
    """(host, in_hosts, in_links, out_hosts, out_links) of every host that links or is linked to."""
    ends = links.select(
        F.explode(F.array(F.struct(F.col("target").alias("host"), F.lit(True).alias("inward")), F.struct(F.col("source").alias("host"), F.lit(False).alias("inward")))).alias("e"),
        "n_links",
    )
    inward, outward = F.col("e.inward"), ~F.col("e.inward")
    return ends.groupBy("e.host").agg(
        F.count_if(inward).alias("in_hosts"),
        F.coalesce(F.sum(F.when(inward, F.col("n_links"))), F.lit(0)).alias("in_links"),
        F.count_if(outward).alias("out_hosts"),
        F.coalesce(F.sum(F.when(outward, F.col("n_links"))), F.lit(0)).alias("out_links"),
    )


def host_ranks(links: DataFrame, damping: float = 0.85, rounds: int = 20, enough: float = 1e-9) -> DataFrame:
    """(host, rank) by random walks along links, each host's links equally likely whatever their number; ranks sum to 1.

    Hosts without links of their own pass their rank to all. Ends after `rounds`, or when no rank changes by more than
    `enough` in sum. Every round is stored, so that plans stay short and lost executors cost one round.
    """
    links = stored(links.select("source", "target").distinct(), "links")
    out = links.groupBy("source").agg(F.count(F.lit(1)).alias("n_out"))
    hosts = links.select(F.explode(F.array("source", "target")).alias("host")).distinct()
    hosts = stored(hosts.join(out.withColumnRenamed("source", "host"), "host", "left"), "hosts")
    n = hosts.count()
    ranks = hosts.select("host", "n_out", F.lit(1.0 / max(n, 1)).alias("rank"))
    for _ in range(rounds if n else 0):
        loose = ranks.filter("n_out IS NULL").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        given = links.join(ranks.select(F.col("host").alias("source"), (F.col("rank") / F.col("n_out")).alias("share")), "source")
        given = given.groupBy(F.col("target").alias("host")).agg(F.sum("share").alias("got"))
        moved = ranks.join(given, "host", "left").withColumn("old", F.col("rank"))
        rank = (1 - damping) / n + damping * (F.coalesce("got", F.lit(0.0)) + loose / n)
        moved = stored(moved.select("host", "n_out", rank.alias("rank"), "old"), "ranks")
        change = moved.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
        ranks = moved.drop("old")
        if change <= enough:
            break
    return ranks.select("host", "rank")


def harvest_rollup(records: DataFrame, groups: list[str], size: str = "warc_record_size", url: str = "url") -> DataFrame:
    """Records, bytes and hosts by every beginning of `groups`, and of all: rows (groups.., level, n_records, n_bytes,
    n_hosts, hosts), null where a group is summed over; `level` is the number of groups that are not.

    Hosts are counted exactly, by distinct pairs that tasks reduce first; `hosts` is a sketch of them, which `merged_hosts` adds
    up over periods and collections without their records.
    """
    per_host = records.groupBy(*groups, host(F.col(url)).alias("_host")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b"))
    per_host = stored(per_host, "hosts-of-groups")
    summed = per_host.rollup(*groups).agg(
        F.sum("n").alias("n_records"),
        F.sum("b").alias("n_bytes"),
        F.count_distinct("_host").alias("n_hosts"),
        F.hll_sketch_agg("_host").alias("hosts"),
        F.grouping_id().alias("_gid"),
    )
    return summed.withColumn("level", F.lit(len(groups)) - F.bit_count("_gid")).drop("_gid")


def merged_hosts(rollups: DataFrame, groups: list[str]) -> DataFrame:
    """Approximate number of distinct hosts by `groups` over rows of several roll-ups."""
    return rollups.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("hosts")).alias("n_hosts"))
