"""Registered queries: prompt context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.functions.columns import archive_key
from medialoom.operators import context as ctx
from medialoom.operators import numbering as num
from medialoom.plans.bindings import Tables
from medialoom.plans.registered import query

LOOKUP = """lookup as (
  select LabelName, max_by(ClassName, ord) as ClassName from classes group by LabelName)"""
TRIPLETS = """triplets as (
  select r.ImageID, r.ord,
         coalesce(a.ClassName, 'Object') || ' ' || r.RelationshipLabel || ' ' ||
         coalesce(b.ClassName, 'Object') as triplet
  from relationships r
  left join lookup a on r.LabelName1 = a.LabelName
  left join lookup b on r.LabelName2 = b.LabelName
  where r.RelationshipLabel is not null)"""
NARR = """narr as (
  select image_id as ImageID, substr(min_by(caption, ord), 1, 300) as caption
  from narratives where image_id <> '' and caption <> '' group by image_id)"""
REL = """rel as (
  select ImageID, string_agg(triplet, '; ' order by ord, triplet) as rels, count(*) as n
  from (select *, row_number() over (partition by ImageID order by ord, triplet) as rn
        from triplets) where rn <= 8 group by ImageID)"""
SCENE = """scene as (
  select ImageID, string_agg(ClassName, ', ' order by ClassName) as objs, count(*) as n
  from (select distinct s.ImageID, l.ClassName from segmentations s
        join lookup l on s.LabelName = l.LabelName) group by ImageID)"""
JOINED = """joined as (
  select s.ImageID, s.MaskPath, s.ord, coalesce(l.ClassName, 'object') as target,
         n.caption, r.rels, c.objs
  from segmentations s left join lookup l on s.LabelName = l.LabelName
  left join narr n on s.ImageID = n.ImageID
  left join rel r on s.ImageID = r.ImageID
  left join scene c on s.ImageID = c.ImageID)"""
ALL = "with " + ",\n".join([LOOKUP, TRIPLETS, NARR, REL, SCENE, JOINED]) + "\n"
CONTEXT = """case when caption is not null then 'Image description: "' || caption || '"' || chr(10)
     when rels is not null then 'Scene relationships: ' || rels || chr(10)
     when objs is not null then 'Objects in the image: ' || objs || chr(10)
     else '' end || 'Object to replace: ' || target"""
TIER = """case when caption is not null then 1 when rels is not null then 2
     when objs is not null then 3 else 4 end"""
REQUEST = """case when caption is not null then 'Somebody told about this photo: "' || caption || '"'
     when rels is not null then 'What can be seen in this photo: ' || rels
     when objs is not null then 'Things in this photo: ' || objs
     else 'There is a ' || target || ' in this photo' end || replace('{}', '~', target)""".format(
    ctx.REQUEST_TEMPLATE.split("{context}")[1].replace("{target}", "~").replace("'", "''")
)
VIEWS = "classes segmentations relationships narratives"


def requests(t: Tables) -> DataFrame:
    seg = t.view("segmentations")
    return ctx.prompt_requests(
        seg, seg, t.view("narratives"), t.view("relationships"), t.view("classes")
    )


def context_rows(t: Tables) -> DataFrame:
    seg, lookup = t.view("segmentations"), ctx.class_lookup(t.view("classes"))
    return ctx.join_context(
        ctx.with_class_names(seg, lookup),
        ctx.first_narrative(t.view("narratives")),
        ctx.relationships_per_image(ctx.relationship_triplets(t.view("relationships"), lookup)),
        ctx.scene_objects(seg, lookup),
        counted=seg,
    )


@query(
    "build_user_message",
    VIEWS,
    ALL + f"select ImageID, MaskPath, {TIER} as tier, {REQUEST} as message from joined",
)
def _(t):
    return requests(t).select("ImageID", "MaskPath", "tier", "message")


@query(
    "best_context",
    VIEWS,
    ALL + f"select ImageID, MaskPath, {TIER} as tier, {CONTEXT} as context from joined",
)
def _(t):
    return ctx.best_context(context_rows(t)).select("ImageID", "MaskPath", "tier", "context")


@query(
    "join_context",
    VIEWS,
    ALL + "select ImageID, MaskPath, caption, rels, objs from joined",
)
def _(t):
    return context_rows(t).select(
        "ImageID",
        "MaskPath",
        "caption",
        F.array_join("relationships", "; ").alias("rels"),
        F.array_join("objects", ", ").alias("objs"),
    )


@query(
    "tier_counts",
    VIEWS,
    ALL
    + f""", tiers as (select {TIER} as tier, count(*) as n from joined group by 1)
select k.tier, coalesce(n, 0) as rows from (select unnest([1, 2, 3, 4]) as tier) k
left join tiers on k.tier = tiers.tier""".replace(", tiers", ", tiers", 1),
)
def _(t):
    return ctx.tier_counts(ctx.best_context(context_rows(t)))


@query("read_classes", "classes", f"with {LOOKUP} select * from lookup")
def _(t):
    return ctx.class_lookup(t.view("classes"))


@query(
    "with_class_names",
    "classes segmentations",
    f"""with {LOOKUP} select s.ImageID, s.MaskPath, s.LabelName, l.ClassName
from segmentations s left join lookup l on s.LabelName = l.LabelName""",
)
def _(t):
    joined = ctx.with_class_names(t.view("segmentations"), ctx.class_lookup(t.view("classes")))
    return joined.select("ImageID", "MaskPath", "LabelName", "ClassName")


@query(
    "relationship_triplets",
    "classes relationships",
    f"with {LOOKUP}, {TRIPLETS} select * from triplets",
)
def _(t):
    return ctx.relationship_triplets(t.view("relationships"), ctx.class_lookup(t.view("classes")))


@query("first_narrative", "narratives", f"with {NARR} select * from narr")
def _(t):
    return ctx.first_narrative(t.view("narratives"))


@query(
    "truncate_caption",
    "narratives",
    "select image_id, ord, substr(caption, 1, 300) as caption from narratives",
)
def _(t):
    return t.view("narratives").withColumn("caption", ctx.truncate_caption(F.col("caption")))


@query(
    "relationships_per_image",
    "classes relationships",
    f"with {LOOKUP}, {TRIPLETS}, {REL} select ImageID, rels, n from rel",
)
def _(t):
    lists = ctx.relationships_per_image(
        ctx.relationship_triplets(t.view("relationships"), ctx.class_lookup(t.view("classes")))
    )
    return lists.select(
        "ImageID",
        F.array_join("relationships", "; ").alias("rels"),
        F.size("relationships").cast("bigint").alias("n"),
    )


@query(
    "scene_objects",
    "classes segmentations",
    f"with {LOOKUP}, {SCENE} select ImageID, objs, n from scene",
)
def _(t):
    lists = ctx.scene_objects(t.view("segmentations"), ctx.class_lookup(t.view("classes")))
    return lists.select(
        "ImageID",
        F.array_join("objects", ", ").alias("objs"),
        F.size("objects").cast("bigint").alias("n"),
    )


@query(
    "first_n_per_key",
    "segmentations",
    """select ImageID, MaskPath from (
  select *, row_number() over (partition by ImageID order by ord) as rn from segmentations)
where rn <= 3""",
)
def _(t):
    return num.first_n_per_key(t.view("segmentations"), ["ImageID"], ["ord"], 3).select(
        "ImageID", "MaskPath"
    )


@query(
    "head_rows_half",
    "segmentations",
    """select ImageID, LabelName, ord from (
  select *, row_number() over (order by LabelName desc, ord) as place, count(*) over () as n from segmentations)
where place <= n // 2""",
)
def _(t):
    from medialoom.operators.sampling import head_rows

    rows = t.view("segmentations")
    first = head_rows(rows, rows.count() // 2, [F.col("LabelName").desc(), "ord"])
    return first.select("ImageID", "LabelName", "ord")


@query(
    "head_rows",
    "segmentations",
    "select ImageID, MaskPath, LabelName from segmentations order by ord limit 1000",
)
def _(t):
    from medialoom.operators.sampling import head_rows

    return head_rows(t.view("segmentations"), 1000, ["ord"]).select(
        "ImageID", "MaskPath", "LabelName"
    )


@query(
    "extract_prompt",
    "responses",
    r"""select conv_id, turn,
  regexp_replace(coalesce(
    case when json_valid(response) then json_extract_string(response, '$.prompt') end,
    nullif(regexp_extract(response, '\{[^{}]*"prompt"\s*:\s*"([^"]+)"[^{}]*\}', 1), ''),
    response), '^\s+|\s+$', '', 'g') as prompt
from responses""",
)
def _(t):
    return ctx.prompts_from_responses(t.view("responses")).select("conv_id", "turn", "prompt")


SHARDS = """shards as (
  select least(ord_no // greatest(total // 12, 1), 11) as shard, ImageID, MaskPath, ord
  from (select *, row_number() over (order by ord) - 1 as ord_no, count(*) over () as total
        from segmentations))"""


def shard_rows(t: Tables) -> DataFrame:
    return num.slice_range(t.view("segmentations"), ["ord"], 12).withColumnRenamed("task", "shard")


@query(
    "merge_shards",
    "segmentations",
    f"with {SHARDS} select 'shard_' || shard as shard_name, ImageID, MaskPath from shards",
)
def _(t):
    named = shard_rows(t).withColumn(
        "shard_name", F.concat(F.lit("shard_"), F.col("shard").cast("string"))
    )
    return ctx.merge_shards(named, order=True).select("shard_name", "ImageID", "MaskPath")


@query(
    "existing_count",
    "segmentations",
    f"with {SHARDS} select shard, count(*) as rows from shards group by shard",
)
def _(t):
    return ctx.existing_count(shard_rows(t))


@query(
    "slice_range",
    "segmentations",
    f"with {SHARDS} select shard as task, ImageID, MaskPath from shards",
)
def _(t):
    return shard_rows(t).select(F.col("shard").alias("task"), "ImageID", "MaskPath")


@query(
    "union_shards",
    "segmentations relationships",
    """select ImageID, ord from segmentations union all select ImageID, ord from relationships""",
)
def _(t):
    return ctx.union_shards(
        [t.view("segmentations").select("ImageID", "ord"), t.view("relationships").select("ImageID", "ord")]
    )


@query(
    "archive_key",
    "segmentations",
    "select MaskPath, lower(substr(MaskPath, 1, 1)) as archive from segmentations",
)
def _(t):
    return t.view("segmentations").select(
        "MaskPath", archive_key(F.col("MaskPath")).alias("archive")
    )
