"""Score lead messages as they arrive and send each one to its places."""

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from leadspark import config
from leadspark.functions import checks
from leadspark.operators import decide, deliver, validate, verify
from leadspark.plans.lead_scoring import score_leads
from leadspark.schemas import ANALYSIS
from leadspark.sources.keyed import KeyedTable
from leadspark.sources.tables import remove, write_batch

PLACES = ("data", "decision", "reason", "destination")


def evidence_table(spark: SparkSession, path: str) -> KeyedTable:
    """Evidence seen so far: each URL once for a set of facts, filed by the facts."""
    return KeyedTable(spark, path, verify.EVIDENCE, ["evidenceId", "sourceURL"], ["evidenceId"])


def outbox_table(spark: SparkSession, path: str, key: str, kind: str) -> KeyedTable:
    """Alerts sent so far, one for each lead."""
    return KeyedTable(spark, path, StructType().add(key, kind).add("payload", "string"), [key])


def checked(messages: DataFrame, key: str) -> DataFrame:
    """Messages as typed leads beside `text` and `first_error`; each is decoded once."""
    found = validate.check(validate.decode(messages), checks.ANALYSIS)
    return validate.typed(found, ANALYSIS, key, "text", "first_error")


def refused(typed: DataFrame, key: str) -> DataFrame:
    """Bad messages at their place, as they came."""
    return typed.where("first_error is not null").select(
        key,
        F.col("text").alias("data"),
        F.lit(None).cast("string").alias("decision"),
        F.col("first_error").alias("reason"),
        F.lit("quarantine").alias("destination"),
    )


def decided(
    typed: DataFrame,
    key: str,
    corpus: DataFrame | None = None,
    proof: DataFrame | None = None,
    trusted: Sequence[str] = config.TRUSTED_HOSTS,
    as_of: str | None = None,
    mine: DataFrame | None = None,
) -> DataFrame:
    """One row per good message and place: key, data (JSON), decision, reason, destination."""
    good = typed.where("first_error is null").select(key, *ANALYSIS.fieldNames())
    final = score_leads(good, as_of=as_of, corpus=corpus, proof=proof, trusted=trusted, mine=mine)
    data = F.when(
        F.col("destination") == "final-leads", F.to_json(deliver.alert_payload())
    ).otherwise(F.to_json(decide.final_record()))
    places = F.explode(decide.destinations(F.col("decision")))
    return final.withColumn("destination", places).select(
        key, data.alias("data"), "decision", F.lit(None).cast("string").alias("reason"), "destination"
    )


def routed(
    messages: DataFrame,
    key: str,
    corpus: DataFrame | None = None,
    trusted: Sequence[str] = config.TRUSTED_HOSTS,
    as_of: str | None = None,
) -> DataFrame:
    """One row per message and place, good and bad ones. Bad ones take no part in joins."""
    typed = checked(messages, key)
    return decided(typed, key, corpus, None, trusted, as_of).unionByName(refused(typed, key))


class LeadScorer:
    """Scores batches of messages against evidence that grows with them.

    Evidence lies in buckets by facts. A batch adds the evidence of its own leads, and reads
    the buckets that its leads have facts in, no others. Alerts go to the outbox, once for
    each lead, however often a message of it comes. Everything is written under the number
    of the batch, so that a batch that is run again changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        kind: str = "long",
        trusted: Sequence[str] = config.TRUSTED_HOSTS,
        as_of: str | None = None,
        together: int = 64,
    ):
        self.path, self.key, self.trusted, self.as_of = path, key, trusted, as_of
        self.together = together
        self.evidence = evidence_table(spark, f"{path}/evidence")
        self.outbox = outbox_table(spark, f"{path}/outbox", key, kind)
        self.spark = spark

    def know(self, articles: DataFrame) -> None:
        """Take articles as evidence from before the first batch."""
        self.evidence.add(verify.whole_evidence(articles, self.trusted), 0, folded=True)

    def proof_for(self, leads: DataFrame, number: int) -> DataFrame:
        """Evidence up to a batch, in the buckets of its leads."""
        asked = verify.with_evidence_id(leads).where("evidenceId is not null")
        return self.evidence.rows(number + 1, self.evidence.buckets_of(asked))

    def add(self, messages: DataFrame, number: int) -> None:
        number += 1  # 0 is what was known before
        path = f"{self.path}/checked/batch={number}"
        typed = checked(messages, self.key)
        typed.write.mode("overwrite").parquet(path)
        typed = self.spark.read.schema(typed.schema).parquet(path)
        good = typed.where("first_error is null")
        keys = self.evidence.key
        found = verify.whole_evidence(good, self.trusted).persist(StorageLevel.MEMORY_AND_DISK)
        others = verify.own_keys(good, self.trusted)
        # What is known is as long as all batches. One look tells which evidence is new, and
        # with the evidence of this batch which leads are among the evidence themselves.
        known = self.evidence.known(found.select(keys).unionByName(others), number)
        kept = [found]
        mine = found.select(keys)
        if known is not None:
            known = known.persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(known)
            mine = mine.unionByName(known.join(others, keys, "left_semi"))
        self.evidence.add(found, number, folded=True, stored=True, known=known)
        proof = self.proof_for(good, number)
        final = decided(typed, self.key, None, proof, self.trusted, self.as_of, mine)
        rows = final.unionByName(refused(typed, self.key))
        write_batch(rows, f"{self.path}/routed", number, "destination")
        for frame in kept:
            frame.unpersist()
        sent = self.routed().where((F.col("batch") == number) & (F.col("destination") == "final-leads"))
        self.outbox.add(sent.select(self.key, F.col("data").alias("payload")), number)
        if number % self.together == 0:
            self.evidence.compact(number)
            self.outbox.compact(number)
        remove(self.spark, path)

    def routed(self) -> DataFrame:
        """What the batches have sent, with their numbers."""
        return self.spark.read.parquet(f"{self.path}/routed")


def start_scoring(scorer: LeadScorer, messages: DataFrame, checkpoint: str) -> StreamingQuery:
    return (
        messages.writeStream.foreachBatch(scorer.add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
