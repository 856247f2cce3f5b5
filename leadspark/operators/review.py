"""Human review: queue, form, actions, corrections and what can be learned from them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.config import NO_COMPANY
from leadspark.schemas import ANALYSIS

FORM_TEXTS = (
    "companyName",
    "industry",
    "region",
    "opportunityType",
    "summary",
    "keyQuote",
)


def review_id(*key: str) -> Column:
    """An id that is the same when a run is repeated."""
    return F.sha2(F.concat_ws("|", F.lit("review"), *key), 256)


def queue_items(review: DataFrame, *key: str) -> DataFrame:
    """Leads for review under their id."""
    return review.withColumn("id", review_id(*key))


def with_own_id(items: DataFrame, store_key: str, document_id: str) -> DataFrame:
    """The id of an item: the one in its document, or else its key in the store."""
    return items.withColumn("id", F.coalesce(document_id, store_key))


def pending(queue: DataFrame, corrections: DataFrame) -> DataFrame:
    """Items that nobody has answered; answers to unknown items do no harm."""
    answered = corrections.where("id is not null").select("id").distinct()
    return queue.join(answered, "id", "left_anti")


def queue_count(queue: DataFrame) -> DataFrame:
    """Number of items, and whether there are none."""
    return queue.agg(F.count(F.lit(1)).alias("n_items")).withColumn(
        "is_empty", F.col("n_items") == 0
    )


def form_view(items: DataFrame) -> DataFrame:
    """Items as a form shows them: blanks for what is missing, one need per line."""
    blank = {name: F.coalesce(name, F.lit("")) for name in FORM_TEXTS}
    title = F.coalesce(
        F.nullif("companyName", F.lit("")), F.lit(NO_COMPANY)
    )
    return items.withColumns(
        {
            "title": title,
            **blank,
            "opportunityScore": F.coalesce("opportunityScore", F.lit(0)),
            "potentialNeed": F.coalesce(
                F.array_join("potentialNeed", "\n", ""), F.lit("")
            ),
        }
    )


def leading_integer(text: Column) -> Column:
    """The whole number a text starts with, NULL without one; 0x starts a hex number."""
    hex_digits = F.regexp_extract(text, r"^\s*[+-]?0[xX]([0-9A-Fa-f]+)", 1)
    sign = F.when(text.rlike(r"^\s*-"), -1).otherwise(1)
    decimal = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1)
    return F.when(
        hex_digits != "", sign * F.conv(hex_digits, 16, 10).try_cast("bigint")
    ).otherwise(decimal.try_cast("bigint"))


def normalised_actions(actions: DataFrame) -> DataFrame:
    """Answers of reviewers as corrections.

    Approve and update carry the form; update also says that it corrects; decline carries
    the id alone.
    """
    keeps_form = F.col("action").isin("approve", "update")
    texts = {name: F.when(keeps_form, F.col(name)) for name in FORM_TEXTS}
    needs = F.filter(F.split("potentialNeed", "\n"), lambda need: need != "")
    return actions.withColumns(
        {
            **texts,
            "potentialNeed": F.when(keeps_form, needs),
            "opportunityScore": F.when(
                keeps_form, leading_integer(F.col("opportunityScore"))
            ),
            "status": F.when(keeps_form, "approved").when(
                F.col("action") == "decline", "declined"
            ),
            "corrected": F.when(F.col("action") == "update", True),
        }
    ).drop("action")


def latest_corrections(corrections: DataFrame, order: str = "submitted_at") -> DataFrame:
    """The last answer per item. Repeated answers are folded before the shuffle."""
    others = [name for name in corrections.columns if name != "id"]
    ranked = [order] + sorted(name for name in others if name != order)
    last = corrections.where("id is not null").groupBy("id").agg(
        F.max(F.struct(*ranked)).alias("row")
    )
    return last.select("id", *[f"row.{name}" for name in others])


def tuning_rows(queue: DataFrame, corrections: DataFrame) -> DataFrame:
    """Items beside their last answer: label 1 or 0, and the names of changed fields."""
    fields = [name for name in ANALYSIS.fieldNames() if name in corrections.columns]
    asked = queue.select("id", F.struct(*fields).alias("original"))
    given = latest_corrections(corrections).select(
        "id", "status", F.struct(*fields).alias("answer")
    )
    approved = F.col("status") == "approved"
    changes = F.array_compact(
        F.array(
            *[
                F.when(
                    approved
                    & ~F.col(f"original.{name}").eqNullSafe(F.col(f"answer.{name}")),
                    F.lit(name),
                )
                for name in fields
            ]
        )
    )
    return asked.join(given, "id").select(
        "id",
        "status",
        F.when(approved, 1).otherwise(0).alias("label"),
        "original",
        "answer",
        changes.alias("changedFields"),
    )
