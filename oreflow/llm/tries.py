"""A prefix trie of conversations by composable monoid fingerprints (operator 13).

A conversation is rebuilt from the head of a base conversation and its own turns from some turn on. No rebuilt
text is made: a turn is one number, a sequence of turns the pair (how many, hash), and two sequences in a
row multiply to one, (m, x) * (n, y) = (m + n, x * B^n + y). Products of every stored conversation's prefixes
are made once. The fingerprint of a rebuilt prefix follows from those of the base's head, of the own prefix and of
the own head that it leaves out: x_own + (x_base - x_left) * B^n.

Equal fingerprints are one node. Each entry keeps a reference to the stored turn it ends with, and a node is
right if its entries' references name equal turns and their prefixes without that turn are one node. That is
checked for all nodes; if it fails for one, another B is taken.

Sums over a subtree need no walk. A node belongs to the smallest of its members, and a conversation owns
the end of its way from some depth on. So a sum over the nodes below is one over the node's members.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import scanned, written

PRIME = 2**127 - 1
HEAD = 5
# Turns of one conversation that are joined as one group.
STRETCH = 4096
EMPTY = bytes(16)


def multiplier(attempt: int, prime: int = PRIME) -> int:
    """The B of an attempt."""
    return _number(sha256(f"turns {attempt}".encode()).digest()) % (prime - 2) + 2


def _number(value: bytes) -> int:
    return int.from_bytes(value, "big")


def _bytes(value: int) -> bytes:
    return value.to_bytes(16, "big")


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn, whose parts are told apart by the role's length."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def prefixes(turns: DataFrame, base: int, prime: int = PRIME) -> DataFrame:
    """Every turn with ``pos`` (from 1), ``prefix`` (the hash of the turns up to it) and ``chars`` (their code points)."""

    def element(value: tuple) -> tuple:
        return 1, _bytes(_number(value[0]) % prime), value[1]

    def product(a: tuple, b: tuple) -> tuple:
        hashed = (_number(a[1]) * pow(base, b[0], prime) + _number(b[1])) % prime
        return a[0] + b[0], _bytes(hashed), a[2] + b[2]

    return scanned(
        turns, "conv_id", ["turn", "digest"], element, product, ["digest", "n_chars"],
        "pos long, prefix binary, chars long",
    )


def default_head(conv_id: Column) -> Column:
    """How many turns of the base a conversation begins with: the unsigned CRC-32 of its id's digits, modulo 6."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)).cast("long")


def default_base(conv_id: Column) -> Column:
    return conv_id - conv_id % 100


def rebuilt(turns: DataFrame, base_of, head_of) -> DataFrame:
    """A row for every rebuilt conversation: its head's entries, and what its own entries need.

    At most ``HEAD`` turns of a conversation are gathered. A base is joined to the conversations that name it.
    """
    first = F.when(F.col("pos") <= HEAD, F.struct("pos", "prefix", "chars", "n_chars", "digest"))
    stored = turns.groupBy("conv_id").agg(
        F.max("pos").alias("n"), F.max("chars").alias("all_chars"), F.array_sort(F.collect_list(first)).alias("start")
    )
    stored = written(stored, "conversations")
    wanted = stored.withColumn("base_id", base_of(F.col("conv_id"))).withColumn("h", head_of(F.col("conv_id")))
    bases = stored.select(F.col("conv_id").alias("base_id"), F.col("start").alias("base_start"))
    joined = wanted.join(bases, "base_id", "left")
    head = F.slice(F.coalesce("base_start", F.slice("start", 1, 0)), F.lit(1), F.col("h").cast("int"))
    joined = joined.withColumn("head", head).withColumn("left_out", F.get("start", F.least("h", "n").cast("int") - 1))
    own = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    last = F.get("head", F.size("head") - 1)
    head_chars = F.coalesce(last["chars"], F.lit(0).cast("long"))
    own_chars = F.when(own > 0, F.col("all_chars") - F.coalesce(F.col("left_out.chars"), F.lit(0))).otherwise(0)
    return joined.select(
        "conv_id", "base_id", "h", "n", "head", F.size("head").cast("long").alias("n_head"),
        (F.size("head") + own).alias("length"), (head_chars + own_chars).alias("total"),
        head_chars.alias("head_chars"), F.coalesce("left_out.chars", F.lit(0).cast("long")).alias("left_chars"),
        F.coalesce(last["prefix"], F.lit(EMPTY)).alias("head_prefix"),
        F.coalesce("left_out.prefix", F.lit(EMPTY)).alias("left_prefix"),
    )


def _stretched(convs: DataFrame, last: Column) -> DataFrame:
    """A row for each stretch of a conversation's turns, so that a long one is joined in many groups."""
    return convs.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / STRETCH))))


def entries(turns: DataFrame, convs: DataFrame, base: int, prime: int) -> DataFrame:
    """A row for every depth of every rebuilt conversation: ``conv_id``, ``depth``, ``print`` and ``parent``
    (fingerprints with and without the last turn), ``digest``, ``n_chars`` and the reference ``ref_conv``,
    ``ref_pos`` of that turn, and ``chars``, the code points up to it. The root is depth 0.
    """
    none = F.lit(0).cast("long")
    roots = convs.select(
        "conv_id", none.alias("depth"), F.lit(EMPTY).alias("print"), F.lit(EMPTY).alias("digest"), none.alias("n_chars"),
        F.lit(None).cast("long").alias("ref_conv"), none.alias("ref_pos"), none.alias("chars"),
    )
    heads = convs.select("conv_id", "base_id", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.pos").alias("depth"), F.col("t.prefix").alias("print"), "t.digest", "t.n_chars",
        F.col("base_id").alias("ref_conv"), F.col("t.pos").alias("ref_pos"), "t.chars",
    )
    facts = ["conv_id", "h", "n_head", "head_chars", "left_chars", "head_prefix", "left_prefix"]
    some = _stretched(convs.filter("n > h").select(*facts, "n"), F.col("n")).drop("n")
    own = turns.withColumn("stretch", F.floor(F.col("pos") / STRETCH)).join(some, ["conv_id", "stretch"])
    own = own.filter("pos > h").select(
        "conv_id", (F.col("n_head") + F.col("pos") - F.col("h")).alias("depth"), F.col("prefix").alias("print"),
        "digest", "n_chars", F.col("conv_id").alias("ref_conv"), F.col("pos").alias("ref_pos"),
        (F.col("chars") - F.col("left_chars") + F.col("head_chars")).alias("chars"),
        (F.col("pos") - F.col("h")).alias("n_own"), "head_prefix", "left_prefix",
    )
    schema = roots.schema.add("parent", "binary")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Fingerprints of the entries that are the conversation's own, and of what is before every entry."""
        inverse = pow(base, -1, prime)
        for batch in batches:
            names, prints, parents = batch.schema.names, [], []
            hashes, turn_hashes = batch.column("print").to_pylist(), batch.column("digest").to_pylist()
            if "n_own" in names:
                more = [batch.column(c).to_pylist() for c in ("n_own", "head_prefix", "left_prefix")]
                for value, n, head, left in zip(hashes, *more, strict=True):
                    moved = (_number(head) - _number(left)) * pow(base, n, prime)
                    prints.append(_bytes((_number(value) + moved) % prime))
            else:
                prints = hashes
            for value, turn in zip(prints, turn_hashes, strict=True):
                parents.append(_bytes((_number(value) - _number(turn) % prime) * inverse % prime))
            columns = [batch.column(f) for f in schema.fieldNames()[:-1]]
            columns[2] = pa.array(prints, pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(parents, pa.binary())], schema.fieldNames())

    roots = roots.withColumn("parent", F.lit(None).cast("binary"))
    return roots.unionByName(heads.mapInArrow(combine, schema)).unionByName(own.mapInArrow(combine, schema))


def nodes_of(every: DataFrame) -> DataFrame:
    """The nodes: entries of one depth and fingerprint. ``sound`` says that their references name equal turns after
    equal prefixes."""
    owner = F.min(F.struct("conv_id", "chars", "n_chars")).alias("least")
    same = (F.min("digest") == F.max("digest")) & F.coalesce(F.min("parent") == F.max("parent"), F.lit(True))
    found = every.groupBy("depth", "print").agg(
        owner, F.count("*").alias("n_convs"), F.min("parent").alias("parent"), same.alias("sound")
    )
    return found.select(
        "depth", "print", "parent", "n_convs", "sound", F.col("least.conv_id").alias("conv_id"),
        (F.col("least.chars") - F.col("least.n_chars")).alias("chars_before"),
    )


def _with_unique(many: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """``many`` with the columns of ``few``, which has a row for every key of it and no key twice.

    A key that has more than a thousandth of the rows, so one of under a thousand, is joined by a broadcast of
    those keys alone, the others by a shuffle.
    """
    most = max(1000, many.count() // 1000)
    hot = many.groupBy(*keys).agg(F.count("*").alias("times")).filter(F.col("times") > most).drop("times")
    hot = written(hot.join(few, keys), "hot")
    return many.join(F.broadcast(hot), keys).unionByName(
        many.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(few, keys)
    )


def ends_digest(ends: DataFrame) -> DataFrame:
    """For every ``print`` and ``depth`` at which conversations end, ``ends_sha256``: the digest of their ids in
    order, joined by commas.

    Ids are ordered in ranges, and each range makes pieces of text of them. A digest needs its text in order,
    so the pieces of one node pass through one task, one after the other; no task holds them together.
    """
    piece = 65_536
    ranged = ends.select("depth", "print", "conv_id").repartitionByRange("depth", "print", "conv_id")
    ranged = ranged.sortWithinPartitions("depth", "print", "conv_id").withColumn("part", F.spark_partition_id())

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("depth", "print", "conv_id", "part")], strict=True)
            out, last, ids = [], None, []
            for k, (depth, mark, conv, part) in enumerate(rows):
                if (depth, mark) != last or len(ids) >= piece:
                    ids = []
                    out.append([depth, mark, part, conv, ids])
                last = (depth, mark)
                ids.append(str(conv))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int64())
            arrays = [pa.array(c, kind) for c, kind in zip(columns[:4], kinds, strict=True)]
            text = pa.array([",".join(ids) for ids in columns[4]], pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, text], ["depth", "print", "part", "first", "ids"])

    cut = ranged.mapInArrow(pieces, "depth long, print binary, part int, first long, ids string")
    cut = cut.repartition("depth", "print").sortWithinPartitions("depth", "print", "first")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, last, state = ["depth", "print", "ends_sha256"], None, None
        kinds = (pa.int64(), pa.binary(), pa.string())
        for batch in batches:
            done = []
            for depth, mark, ids in zip(*[batch.column(c).to_pylist() for c in ("depth", "print", "ids")], strict=True):
                if (depth, mark) != last:
                    if last is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = (depth, mark), sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            columns = list(zip(*done, strict=True)) if done else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        if last is not None:
            row = (*last, state.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    return cut.mapInArrow(join, "depth long, print binary, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, base_of=default_base, head_of=default_head, prime: int = PRIME, attempts: int = 8
) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations; one row for each distinct prefix, the root included.

    ``conv_id`` is the smallest member, ``depth`` the number of turns, ``parent_conv_id`` the parent's ``conv_id``
    (null for the root), ``n_convs`` the members, ``n_children`` the children, ``n_leaves`` the nodes without
    children in the subtree, ``saved_tokens`` the sum over the subtree of (members - 1) times the code points
    of the last text, ``ends_sha256`` the digest of the ids of the members that end there, ``ref_conv`` and
    ``ref_pos`` the stored turn that a member ends with there.

    Turns are ordered by ``turn``, null first, equal ones by their content's digest; null roles and texts are
    empty. ``head_of`` gives at most 5. Rows without a ``conv_id`` belong to no conversation. Rows that stand
    twice are two turns. A conversation may have no turns once it is rebuilt; it ends at the root. An empty
    table has no nodes.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest(role, text).alias("digest"),
        F.char_length(text).cast("long").alias("n_chars"),
    )
    turns = written(turns, "turns")
    for attempt in range(attempts):
        base = multiplier(attempt, prime)
        scans = written(prefixes(turns, base, prime), "prefixes")
        convs = written(rebuilt(scans, base_of, head_of), "rebuilt")
        every = written(entries(scans, convs, base, prime), "entries")
        nodes = written(nodes_of(every), "nodes")
        if nodes.filter(~F.col("sound")).isEmpty():
            break
        prime = PRIME
    else:
        raise RuntimeError("no multiplier tells all prefixes apart")

    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("print"))
    children = children.agg(F.count("*").alias("n_children"))
    none = F.lit(0).cast("long")
    nodes = nodes.join(children, ["depth", "print"], "left").withColumn("n_children", F.coalesce("n_children", none))
    nodes = written(nodes, "nodes")

    # what a conversation owns: from which depth on, how much text, and whether it ends at a leaf
    owned = nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", "chars_before")).alias("top"),
        F.max((F.col("n_children") == 0).cast("long")).alias("leaf"),
    )
    facts = convs.select("conv_id", "length", "total").join(owned, "conv_id", "left").select(
        "conv_id", "length", "total", F.col("top.depth").alias("owns_from"), F.coalesce("leaf", none).alias("leaf"),
        F.coalesce(F.col("total") - F.col("top.chars_before"), none).alias("owned"),
    )
    facts = _stretched(facts, F.col("length"))
    members = every.withColumn("stretch", F.floor(F.col("depth") / STRETCH)).join(facts, ["conv_id", "stretch"])
    below = F.col("total") - F.col("chars") + F.col("n_chars") - F.col("owned")
    saved = F.when(F.col("depth") >= F.col("owns_from"), none).otherwise(below)
    members = members.select(
        "conv_id", "depth", "print", "leaf", saved.alias("saved"), "ref_conv", "ref_pos",
        (F.col("depth") == F.col("length")).alias("ends"),
    )
    members = written(members, "members")
    sums = members.groupBy("depth", "print").agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
        F.min(F.struct("ref_conv", "ref_pos")).alias("ref"),
    )
    ends = ends_digest(members.filter("ends"))
    nodes = nodes.join(sums, ["depth", "print"]).join(ends, ["depth", "print"], "left")
    ended = F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest()))
    nodes = written(nodes.withColumn("ends_sha256", ended), "nodes")

    parents = nodes.select(F.col("depth").alias("up"), F.col("print").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    inner = _with_unique(nodes.filter("depth > 0").withColumn("up", F.col("depth") - 1), parents, ["up", "parent"])
    root = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
        F.col("ref.ref_conv"), F.col("ref.ref_pos"),
    ]
    return root.select(*columns).unionByName(inner.select(*columns))
