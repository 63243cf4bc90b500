"""Keyed state kept by a table of JSON commands.

A command is ``(seq, method, payload)``. All commands of a batch are applied
at once, with the result of applying them one after another by ``seq``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.text import to_boolean
from cargolens.operators.ordered import carry_forward
from cargolens.session import staged


@dataclass(frozen=True)
class Feed:
    """Columns of one kind of command and what its methods mean."""

    key: str
    fields: dict[str, tuple[str, str]]  # column: (payload field, type)
    created: tuple[str, ...]  # kept from the insert on
    can_delete: bool = False
    reads: str | None = None  # column returned by method S


# Payload fields of the two feeds.
PREFERENCES = Feed(
    key="web_user_master_id",
    fields={
        "web_user_master_id": ("webUserMasterId", "bigint"),
        "column_preferences": ("columnPreferences", "json"),
        "create_user": ("createUser", "text"),
        "create_date": ("createDate", "timestamp"),
        "update_user": ("updateUser", "text"),
        "update_date": ("updateDate", "timestamp"),
        "registration_no": ("registrationNo", "text"),
        "version": ("version", "int"),
        "customer_id": ("nxtCustomerId", "blank bigint"),
    },
    created=("create_user", "create_date"),
    reads="column_preferences",
)
TRIGGERS = Feed(
    key="web_user_master_id",
    fields={
        "web_user_master_id": ("webUserMasterId", "bigint"),
        "created_user": ("createUser", "text"),
        "created_date": ("createDate", "timestamp"),
        "updated_user": ("updateUser", "text"),
        "updated_date": ("updateDate", "timestamp"),
        "mail_id": ("mailId", "array"),
        "day_status": ("dayStatus", "boolean"),
        "days": ("days", "array"),
        "status_list": ("statusList", "array"),
        "last_trigger_date": ("lastTriggeredDate", "timestamp"),
    },
    created=("created_user", "created_date"),
    can_delete=True,
)

# Reply texts.
INSERTED, UPDATED, DELETED = "SUCCESS - INSERTED", "SUCCESS - UPDATED", "SUCCESS - DELETED"
INVALID = "ERROR - INVALID METHOD"


def _typed(text: Column, doc: Column, name: str, type_: str) -> Column:
    """Typed value of a payload field; NULL when missing or unfit."""
    if type_ == "json":
        return F.to_json(F.try_variant_get(doc, f"$.{name}", "variant"))
    if type_ == "array":
        items = F.try_variant_get(doc, f"$.{name}", "array<string>")
        return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(items)
    if type_ == "boolean":
        return to_boolean(text)
    if type_ in ("timestamp", "blank bigint"):
        return F.nullif(text, F.lit("")).try_cast("timestamp_ntz" if type_ == "timestamp" else "bigint")
    return text if type_ == "text" else text.try_cast(type_)


def parse_commands(commands: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """Typed commands, and the rejected ones with the reason; the batch goes on.

    Payloads are parsed once and the typed rows written to the scratch folder,
    as applying them reads them several times. Of a field given twice the last
    value counts; arrays are kept as written, without blanks between items.
    """
    commands.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    doc = F.explode(F.array(F.try_parse_json("payload"))).alias("_doc")
    docs = commands.select("seq", "method", "payload", doc)
    texts = {f"_t_{c}": F.try_variant_get("_doc", f"$.{name}", "string") for c, (name, ty) in feed.fields.items() if ty != "json"}
    docs = docs.withColumns(texts)
    values, reasons = [], []
    for column, (name, type_) in feed.fields.items():
        text = F.col(f"_t_{column}") if type_ != "json" else None
        values.append(_typed(text, F.col("_doc"), name, type_).alias(column))
        if type_ not in ("json", "text"):
            given = text != "" if type_ in ("timestamp", "blank bigint") else text.isNotNull()
            reasons.append(F.when(given & F.col(column).isNull(), F.lit(f"FAILED - bad value for {column}")))
    malformed = F.col("payload").isNotNull() & F.col("_doc").isNull()
    reason = F.coalesce(F.when(malformed, F.lit("FAILED - malformed payload")), *reasons)
    typed = docs.select("*", *values).withColumn("_reason", reason)
    kept = F.when(F.col("_reason").isNotNull(), F.col("payload")).alias("payload")
    parsed = staged(typed.select("seq", "method", kept, *feed.fields, "_reason"), "commands")
    ok = parsed.filter(F.col("_reason").isNull()).drop("_reason", "payload")
    rejects = parsed.filter(F.col("_reason").isNotNull())
    return ok, rejects.select("seq", "method", "payload", F.col("_reason").alias("status"))


def command_statuses(base: DataFrame, commands: DataFrame, feed: Feed) -> DataFrame:
    """Parsed commands with the reply each one gets."""
    key, method = feed.key, F.col("method")
    changes = method.isin("U", "D") if feed.can_delete else method == "U"
    read = F.col(feed.reads) if feed.reads else F.lit(None).cast("string")
    effect = F.when(changes, F.struct(method.alias("op"), read.alias("read")))
    keyed = carry_forward(
        commands.filter(F.col(key).isNotNull()), [key], ["seq"], effect, "_before", include_current=False
    )
    known = base.filter(F.col(key).isNotNull()).select(key, (read if feed.reads else F.lit(None).cast("string")).alias("_base_read"))
    known = known.withColumn("_in_base", F.lit(True))
    joined = keyed.join(known, key, "left")
    exists = F.when(F.col("_before").isNotNull(), F.col("_before.op") == "U").otherwise(F.coalesce("_in_base", F.lit(False)))
    loose = commands.filter(F.col(key).isNull())

    def reply(exists: Column, stored: Column) -> Column:
        text = F.when(method == "U", F.when(exists, UPDATED).otherwise(INSERTED))
        if feed.can_delete:
            text = text.when(method == "D", DELETED)
        if feed.reads:
            text = text.when(method == "S", stored)
        return text.otherwise(INVALID)

    stored = F.when(F.col("_before").isNotNull(), F.col("_before.read")).otherwise(F.col("_base_read"))
    done = joined.withColumn("status", reply(exists, stored)).drop("_before", "_base_read", "_in_base")
    return done.unionByName(loose.withColumn("status", reply(F.lit(False), F.lit(None).cast("string"))))


def apply_commands(base: DataFrame, commands: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """State after the batch, and the commands with their replies.

    Created fields come from the latest insert; all others from the latest
    upsert. A last delete removes the key. Commands without a key insert a row
    each, as no stored row equals NULL.
    """
    statuses = command_statuses(base, commands, feed)
    columns = list(feed.fields)
    rest = [c for c in columns if c != feed.key]
    method = F.col("method")
    changes = method.isin("U", "D") if feed.can_delete else method == "U"
    inserted_at = F.when(F.col("status") == INSERTED, F.col("seq"))
    net = (
        statuses.filter(F.col(feed.key).isNotNull() & changes)
        .groupBy(feed.key)
        .agg(
            F.max_by(F.struct(method.alias("op"), *rest), "seq").alias("_last"),
            F.max_by(F.struct(*feed.created), inserted_at).alias("_made"),
        )
    )
    old = base.filter(F.col(feed.key).isNotNull()).select(feed.key, F.struct(*rest).alias("_old"))
    merged = old.join(net, feed.key, "full").filter(F.col("_last").isNull() | (F.col("_last.op") == "U"))
    values = []
    for c in rest:
        new = F.col(f"_last.{c}")
        if c in feed.created:
            new = F.when(F.col("_made").isNotNull(), F.col(f"_made.{c}")).otherwise(F.col(f"_old.{c}"))
        values.append(F.when(F.col("_last").isNull(), F.col(f"_old.{c}")).otherwise(new).alias(c))
    state = merged.select(feed.key, *values)
    loose = base.filter(F.col(feed.key).isNull()).select(feed.key, *rest)
    added = statuses.filter(F.col(feed.key).isNull() & (method == "U")).select(feed.key, *rest)
    return state.unionByName(loose).unionByName(added), statuses.select("seq", "method", feed.key, "status")
