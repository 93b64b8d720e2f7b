"""Label noise and text noise as table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import bucket, uniform
from ..sources.scratch import materialise
from ..sources.tables import CLASSES
from .ranking import grouped_rank, with_exact_cuts

NOISE_RATE = 0.10
NOISE_SEED = 42

# The sentences and phrases added to texts.
NEUTRAL_SENTENCES = [
    "The information was verified through multiple independent channels.",
    "Several organizations contributed to the analysis presented here.",
    "Data from government agencies formed the basis of this report.",
    "Community responses have been varied across different regions.",
    "Historical precedent suggests cautious interpretation is warranted.",
    "Market analysts continue to monitor the evolving situation closely.",
    "The implications for consumers and businesses remain to be seen.",
    "Policy frameworks will need updating to reflect new realities.",
    "Cross-referencing official records reveals a complex picture.",
    "Both proponents and critics have raised valid concerns.",
]
NOISE_PHRASES = [
    "according to sources familiar with the matter",
    "the situation continues to develop",
    "officials declined to comment on the record",
    "data analysis shows mixed results",
    "experts remain divided on the implications",
    "further investigation is warranted",
    "the full report is expected next quarter",
    "stakeholders expressed varying opinions",
    "economic indicators remain volatile",
    "political tensions complicate the outlook",
    "public opinion surveys show shifting attitudes",
    "regulatory frameworks are under review",
    "international cooperation remains essential",
    "technological disruption accelerates change",
    "fiscal responsibility demands careful planning",
]


def _budget(rate: float):
    """Rows of a class that get noise, and the half that gets foreign text."""
    return {
        "text": lambda n: F.floor(F.floor(n * rate) / 2),
        "any": lambda n: F.floor(n * rate),
    }


def flip_labels(df: DataFrame, rate: float = NOISE_RATE, seed=NOISE_SEED, id_col: str = "doc_id", classes=CLASSES) -> DataFrame:
    """Flip an exact number of labels per class: the second half of the noise
    budget (the first half is for ``cross_contaminate``)."""
    joined, within = with_exact_cuts(df, "label", classes, seed, _budget(rate), id_col)
    flipped = within["any"] & ~within["text"]
    return joined.select(
        *[c for c in df.columns if c != "label"],
        F.when(flipped, 1 - F.col("label")).otherwise(F.col("label")).alias("label"),
        flipped.alias("flipped"),
    )


def cross_contaminate(df: DataFrame, rate: float = NOISE_RATE, seed=NOISE_SEED, id_col: str = "doc_id",
                      text_col: str = "text", classes=CLASSES) -> DataFrame:
    """Keep the first half of the words and append a text of the other class.

    The i-th chosen row of a class gets the i-th donor of the other class
    (donors repeat if there are too few).  Only ids and ranks take part in
    the pairing, which works on a written table of ids; the table of texts is
    read twice, for the donors and for the rows themselves.
    """
    ids = materialise(df.select(id_col, "label").where(F.col("label").isin(list(classes))), "noise-ids")
    chosen_rank = grouped_rank(ids, ["label"], seed, id_col, count_col="_n")
    n_text = F.floor(F.floor(F.col("_n") * rate) / 2)
    chosen = chosen_rank.where(F.col("rank") <= n_text).select(
        id_col, (1 - F.col("label")).alias("_donor_label"), (F.col("rank") - 1).alias("_i"))
    donors = grouped_rank(ids, ["label"], f"{seed}-donor", id_col, count_col="_n")
    # One row per class: its size, and how many donors the other class asks of it.
    sizes = ids.groupBy("label").agg(F.count("*").alias("_size"))
    asked = sizes.select((1 - F.col("label")).alias("label"), F.floor(F.floor(F.col("_size") * rate) / 2).alias("_asked"))
    slots = chosen.join(
        F.broadcast(sizes.select(F.col("label").alias("_donor_label"), F.col("_size").alias("_donors"))), "_donor_label"
    ).select(id_col, "_donor_label", (F.col("_i") % F.col("_donors") + 1).alias("_slot"))
    offered = donors.join(F.broadcast(asked), "label").where(F.col("rank") <= F.col("_asked")).select(
        F.col("label").alias("_donor_label"), F.col("rank").alias("_slot"), F.col(id_col).alias("_donor_id"))
    pairs = materialise(slots.join(offered, ["_donor_label", "_slot"]).select(id_col, "_donor_id"), "noise-pairs")
    texts = df.select(F.col(id_col).alias("_donor_id"), F.col(text_col).alias("_donor_text"))
    donated = pairs.join(texts, "_donor_id").select(id_col, "_donor_id", "_donor_text")

    words = F.filter(F.split(F.col(text_col), r"\s+"), lambda w: w != "")
    half = F.array_join(F.slice(words, 1, F.floor(F.size(words) / 2).cast("int")), " ")
    mixed = F.when(F.col("_donor_id").isNotNull(), F.concat(half, F.lit(" "), F.col("_donor_text"))).otherwise(F.col(text_col))
    return df.join(donated, id_col, "left").select(
        *[c for c in df.columns if c != text_col],
        mixed.alias(text_col),
        F.col("_donor_id").alias("donor_id"),
    )


def append_neutral(df: DataFrame, rate: float = 0.25, seed="neutral", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Append one neutral sentence to about ``rate`` of the rows."""
    pick = F.get(F.array(*[F.lit(s) for s in NEUTRAL_SENTENCES]), bucket(f"{seed}-pick", len(NEUTRAL_SENTENCES), id_col).cast("int"))
    hit = uniform(seed, id_col) < rate
    return df.withColumn(text_col, F.when(hit, F.concat(text_col, F.lit(" "), pick)).otherwise(F.col(text_col)))


def insert_noise(df: DataFrame, rate: float = 0.45, seed="noise", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Insert one or two different phrases at a sentence boundary of about
    ``rate`` of the rows.  A boundary is a full stop followed by a blank."""
    n = len(NOISE_PHRASES)
    phrases = F.array(*[F.lit(p.capitalize() + ".") for p in NOISE_PHRASES])
    staged = df.withColumn("_parts", F.split(F.col(text_col), r"(?<=\.) ")).withColumns({
        "_first": bucket(f"{seed}-first", n, id_col).cast("int"),
        "_step": (bucket(f"{seed}-step", n - 1, id_col) + 1).cast("int"),
        "_two": bucket(f"{seed}-count", 2, id_col) == 1,
        "_at": F.pmod(bucket(f"{seed}-at", 1 << 30, id_col), F.size("_parts") + 1).cast("int"),
    })
    one = F.get(phrases, F.col("_first"))
    other = F.get(phrases, F.pmod(F.col("_first") + F.col("_step"), F.lit(n)))
    # The second phrase goes to the same position, hence in front.
    added = F.when(F.col("_two"), F.array(other, one)).otherwise(F.array(one))
    head = F.slice("_parts", F.lit(1), F.col("_at"))
    tail = F.slice("_parts", F.col("_at") + 1, F.size("_parts"))
    noisy = F.array_join(F.concat(head, added, tail), " ")
    return staged.withColumn(text_col, F.when(uniform(seed, id_col) < rate, noisy).otherwise(F.col(text_col))).select(*df.columns)
