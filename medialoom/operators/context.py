"""Prompt context from annotation tables: captions, relationships, object lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import extract_prompt
from medialoom.operators.numbering import first_n_per_key
from medialoom.operators.skew import salted_left_join

# Default wording of the request; callers may pass their own template. {context}
# and {target} are filled in for every row.
LEAD_NARRATIVE = 'Somebody told about this photo: "%s"'
LEAD_RELATIONS = "What can be seen in this photo: %s"
LEAD_OBJECTS = "Things in this photo: %s"
LEAD_CLASS = "There is a %s in this photo"
REQUEST_TEMPLATE = (
    "{context}\n\n"
    "An inpainting model will repaint the {target} of this photo. Describe in one or two "
    "sentences what should stand where the {target} is now: another material, colour, "
    "pattern, period or object that fits the scene and could be photographed. "
    'Answer with one JSON object whose only key is "prompt".'
)


def class_lookup(classes: DataFrame) -> DataFrame:
    """One class name per label; of repeated labels the last in file order counts."""
    return classes.groupBy("LabelName").agg(F.max_by("ClassName", "ord").alias("ClassName"))


def with_class_names(segmentations: DataFrame, classes: DataFrame) -> DataFrame:
    """Left join of the class name."""
    return segmentations.join(classes, "LabelName", "left")


def relationship_triplets(relationships: DataFrame, classes: DataFrame) -> DataFrame:
    """Text "class relation class" per row; unknown labels read Object, null relations drop."""
    first = classes.select(
        F.col("LabelName").alias("LabelName1"), F.col("ClassName").alias("_name1")
    )
    second = classes.select(
        F.col("LabelName").alias("LabelName2"), F.col("ClassName").alias("_name2")
    )
    related = relationships.filter(F.col("RelationshipLabel").isNotNull())
    named = related.join(first, "LabelName1", "left").join(second, "LabelName2", "left")
    missing = F.lit(fv.MISSING_CLASS)
    return named.select(
        "ImageID",
        "ord",
        F.concat_ws(
            " ",
            F.coalesce("_name1", missing),
            "RelationshipLabel",
            F.coalesce("_name2", missing),
        ).alias("triplet"),
    )


def truncate_caption(caption: Column, n: int = fv.CAPTION_CHARS) -> Column:
    return F.substring(caption, 1, n)


def first_narrative(narratives: DataFrame, chars: int = fv.CAPTION_CHARS) -> DataFrame:
    """First non-empty caption of each image, cut to its first characters.

    The cut comes before the grouping, so the shuffle moves short texts only.
    """
    kept = narratives.filter((F.col("image_id") != "") & (F.col("caption") != ""))
    return kept.groupBy(F.col("image_id").alias("ImageID")).agg(
        F.min_by(truncate_caption(F.col("caption"), chars), "ord").alias("caption")
    )


def relationships_per_image(
    triplets: DataFrame, n: int = fv.RELATIONS_PER_IMAGE
) -> DataFrame:
    """First n triplets of each image in file order, as a list."""
    first = first_n_per_key(triplets, ["ImageID"], ["ord", "triplet"], n)
    pairs = F.array_sort(F.collect_list(F.struct("ord", "triplet")))
    return first.groupBy("ImageID").agg(
        F.transform(pairs, lambda p: p["triplet"]).alias("relationships")
    )


def scene_objects(segmentations: DataFrame, classes: DataFrame) -> DataFrame:
    """Sorted distinct class names of each image.

    Pairs are made distinct on (image, class) first: a hot image is spread over
    its classes and every task sends each pair once.
    """
    pairs = (
        segmentations.select("ImageID", "LabelName")
        .distinct()
        .join(classes, "LabelName")
        .filter(F.col("ClassName").isNotNull())
        .select("ImageID", "ClassName")
        .distinct()
    )
    return pairs.groupBy("ImageID").agg(
        F.array_sort(F.collect_list("ClassName")).alias("objects")
    )


def image_context(
    narratives: DataFrame, relationships: DataFrame, scenes: DataFrame
) -> DataFrame:
    """One row per image with whatever context exists for it."""
    text = "string"
    listed = "array<string>"
    nothing, no_list = F.lit(None).cast(text), F.lit(None).cast(listed)
    parts = (
        narratives.select(
            "ImageID", "caption", no_list.alias("relationships"), no_list.alias("objects")
        )
        .unionByName(
            relationships.select(
                "ImageID", nothing.alias("caption"), "relationships", no_list.alias("objects")
            )
        )
        .unionByName(
            scenes.select(
                "ImageID", nothing.alias("caption"), no_list.alias("relationships"), "objects"
            )
        )
    )
    return parts.groupBy("ImageID").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("caption", "relationships", "objects")]
    )


def join_context(
    rows: DataFrame,
    narratives: DataFrame,
    relationships: DataFrame,
    scenes: DataFrame,
    spread: list[str] = ("ord",),
    counted: DataFrame | None = None,
) -> DataFrame:
    """Attach caption, relationships and objects by image; hot images are spread.

    ``counted`` is the table that ``rows`` was made from, if there is one to count images on."""
    context = image_context(narratives, relationships, scenes)
    return salted_left_join(rows, context, "ImageID", list(spread), counted=counted)


def _target() -> Column:
    return F.coalesce(F.col("ClassName"), F.lit("object"))


def _tier() -> Column:
    return (
        F.when(F.col("caption").isNotNull(), 1)
        .when(F.col("relationships").isNotNull(), 2)
        .when(F.col("objects").isNotNull(), 3)
        .otherwise(4)
    )


def best_context(rows: DataFrame) -> DataFrame:
    """Context text and tier: caption, else relationships, else objects, else class."""
    relations = F.array_join("relationships", fv.RELATION_SEPARATOR)
    objects = F.array_join("objects", fv.OBJECT_SEPARATOR)
    lead = (
        F.when(F.col("caption").isNotNull(), F.format_string(fv.CONTEXT_NARRATIVE, "caption"))
        .when(F.col("relationships").isNotNull(), F.format_string(fv.CONTEXT_RELATIONS, relations))
        .when(F.col("objects").isNotNull(), F.format_string(fv.CONTEXT_OBJECTS, objects))
        .otherwise("")
    )
    replace = F.format_string(fv.CONTEXT_CLASS, _target())
    return rows.withColumn("context", F.concat(lead, replace)).withColumn("tier", _tier())


def build_user_message(rows: DataFrame, template: str = REQUEST_TEMPLATE) -> DataFrame:
    """Request text for the text model, with the same priority as best_context."""
    relations = F.array_join("relationships", fv.RELATION_SEPARATOR)
    objects = F.array_join("objects", fv.OBJECT_SEPARATOR)
    context = (
        F.when(F.col("caption").isNotNull(), F.format_string(LEAD_NARRATIVE, "caption"))
        .when(F.col("relationships").isNotNull(), F.format_string(LEAD_RELATIONS, relations))
        .when(F.col("objects").isNotNull(), F.format_string(LEAD_OBJECTS, objects))
        .otherwise(F.format_string(LEAD_CLASS, _target()))
    )
    before, after = template.split("{context}", 1)
    message = F.concat(
        F.replace(F.lit(before), F.lit("{target}"), _target()),
        context,
        F.replace(F.lit(after), F.lit("{target}"), _target()),
    )
    return rows.withColumn("message", message)


def tier_counts(rows: DataFrame) -> DataFrame:
    """Rows of each tier 1 to 4, zero where there are none."""
    counted = rows.agg(*[F.count_if(F.col("tier") == t).alias(f"t{t}") for t in (1, 2, 3, 4)])
    listed = F.array(
        *[F.struct(F.lit(t).alias("tier"), F.col(f"t{t}").alias("rows")) for t in (1, 2, 3, 4)]
    )
    return counted.select(F.inline(listed))


def prompts_from_responses(responses: DataFrame) -> DataFrame:
    return responses.withColumn("prompt", extract_prompt(F.col("response")))


def prompt_requests(
    rows: DataFrame,
    segmentations: DataFrame,
    narratives: DataFrame,
    relationships: DataFrame,
    classes: DataFrame,
) -> DataFrame:
    """The whole flow from annotations to request texts."""
    lookup = class_lookup(classes)
    joined = join_context(
        with_class_names(rows, lookup),
        first_narrative(narratives),
        relationships_per_image(relationship_triplets(relationships, lookup)),
        scene_objects(segmentations, lookup),
        counted=rows,
    )
    return build_user_message(best_context(joined))


def merge_shards(shards: list[DataFrame] | DataFrame, order: bool = False) -> DataFrame:
    """All shards as one table; in text order of the shard name only where asked for."""
    if isinstance(shards, DataFrame):
        merged = shards
    else:
        merged = union_shards(shards)
    return merged.orderBy("shard_name", "ord") if order else merged


def union_shards(shards: list[DataFrame]) -> DataFrame:
    merged = shards[0]
    for s in shards[1:]:
        merged = merged.unionByName(s)
    return merged


def existing_count(shards: DataFrame) -> DataFrame:
    """Finished rows of each shard that is already there."""
    return shards.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
