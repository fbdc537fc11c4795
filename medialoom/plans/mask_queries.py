"""Registered queries: masks, frames, archive members."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.functions import columns as col
from medialoom.operators import masks as ops
from medialoom.operators import sampling as smp
from medialoom.operators import scoring
from medialoom.plans.bindings import LINE_KEY, Tables
from medialoom.plans.registered import query
from medialoom.session import scratch_folder
from medialoom.sources import archives
from medialoom.sources.writers import write_binary_files

SIDE = 8  # 64 floats as a grid


def masks(t: Tables, cut: float = 0.0) -> DataFrame:
    """Every embedding as an 8 by 8 mask: 255 where the value is above the cut."""
    pixel = F.transform("embedding", lambda x: F.when(x > cut, F.lit("FF")).otherwise(F.lit("00")))
    return t.table("embeddings").select(
        F.concat(F.lit("m"), F.col("vec_id").cast("string")).alias("path"),
        F.lit(SIDE).alias("height"),
        F.lit(SIDE).alias("width"),
        F.unhex(F.array_join(pixel, "")).alias("data"),
    )


PIXELS = """cells as (select 'm' || vec_id as path, unnest(embedding) as v, unnest(range(64)) as i from embeddings),
px as (select path, (i // 8)::int as y, (i % 8)::int as x, v > 0 as on_ from cells)"""
NUMBER = "('0x' || substr(md5('42|{0}|' || path), 1, 8))::bigint"


def number(name: str) -> str:
    return NUMBER.format(name)


PARAMETERS = {
    "job": f"""select path, ['ellipse', 'rect', 'cross'][1 + {number('kernel')} % 3] as kernel,
  7 as kernel_width, 7 as kernel_height, 1 as rounds,
  case when {number('soft')} % 2 = 0 then [3, 5, 7][1 + {number('blur')} % 3] else 0 end as blur,
  127 as threshold from (select distinct path from cells)""",
    "once": f"""select path, ['ellipse', 'rect', 'cross'][1 + {number('kernel')} % 3] as kernel,
  11 as kernel_width, (8 + {number('height')} % 7)::int as kernel_height,
  case when {number('rounds')} < 0.8 * 4294967296 then 1 else 2 end as rounds,
  case when {number('edge')} < 0.4 * 4294967296 then 0
    when {number('edge')} < 0.8 * 4294967296 then [3, 5][1 + {number('blur')} % 2]
    else [5, 7, 9][1 + {number('blur')} % 3] end as blur,
  case when {number('edge')} >= 0.8 * 4294967296 then 100 else 127 end as threshold
from (select distinct path from cells)""",
}

for profile, text in PARAMETERS.items():

    @query(f"dilation_parameters_{profile}", "", f"with {PIXELS} {text}")
    def _(t, profile=profile):
        drawn = ops.dilation_parameters(masks(t), profile)
        return drawn.select(
            "path", "kernel", "kernel_width", "kernel_height", "rounds", "blur", "threshold"
        )


# a pixel is set if one under the kernel is; the pixels are joined with themselves
DILATED = """select distinct a.path, a.y, a.x from px a join px b
on a.path = b.path and b.on_ and {0}"""
UNDER = {
    "rect": "abs(a.y - b.y) <= 2 and abs(a.x - b.x) <= 2",
    "cross": "((a.y = b.y and abs(a.x - b.x) <= 2) or (a.x = b.x and abs(a.y - b.y) <= 2))",
    # round(2 * sqrt(4 - dy * dy) / 2) for dy 0, 1, 2
    "ellipse": "abs(a.x - b.x) <= case abs(a.y - b.y) when 0 then 2 when 1 then 2 when 2 then 0 else -1 end",
}

for kernel, rule in UNDER.items():

    @query(f"dilate_{kernel}", "", f"with {PIXELS.replace('v > 0 ', 'v > 0.2 ')} {DILATED.format(rule)}")
    def _(t, kernel=kernel):
        drawn = ops.fixed_parameters(masks(t, 0.2), kernel, 2)
        return ops.set_pixels(ops.dilate_masks(drawn))


# the whole job profile: kernels of 7 by 7, then for the soft half a blur that sets a
# pixel whose weighted share of set pixels is at least half; borders are mirrored
JOB = f"""with {PIXELS.replace('v > 0 ', 'v > 0.25 ')},
drawn as ({PARAMETERS['job']}),
grown as (
  select a.path, a.y, a.x, max(case when b.on_ and case d.kernel when 'rect' then true
      when 'cross' then a.y = b.y or a.x = b.x
      else abs(a.x - b.x) <= case abs(a.y - b.y) when 0 then 3 when 1 then 3 when 2 then 2 else 0 end end
    then 1 else 0 end) as on_
  from px a join drawn d on a.path = d.path
  join px b on a.path = b.path and abs(a.y - b.y) <= 3 and abs(a.x - b.x) <= 3 group by all),
weights as (
  select * from (values (0, 0, 1.0::double), (3, -1, 0.25), (3, 0, 0.5), (3, 1, 0.25),
    (5, -2, 0.0625), (5, -1, 0.25), (5, 0, 0.375), (5, 1, 0.25), (5, 2, 0.0625),
    (7, -3, 0.03125), (7, -2, 0.109375), (7, -1, 0.21875), (7, 0, 0.28125), (7, 1, 0.21875),
    (7, 2, 0.109375), (7, 3, 0.03125)) w(size, d, w)),
mirrored as (
  select g.path, g.y, g.x, wy.w * wx.w as w,
    7 - abs(7 - abs(g.y + wy.d)) as sy, 7 - abs(7 - abs(g.x + wx.d)) as sx
  from grown g join drawn d on g.path = d.path
  join weights wy on wy.size = d.blur join weights wx on wx.size = d.blur)
select m.path, m.y, m.x from mirrored m join grown s on s.path = m.path and s.y = m.sy and s.x = m.sx
group by all having sum(m.w * s.on_) >= 0.5"""


@query("dilate_masks_job", "", JOB)
def _(t):
    return ops.set_pixels(ops.dilate_masks(ops.dilation_parameters(masks(t, 0.25), "job")))


# the other profile: kernels 11 wide and 8 to 14 high, once or twice, blurs of up to 9; a kernel's
# centre is at half its size, and an even one reaches less far down. Row dy of an ellipse reaches
# round(cx * sqrt(cy^2 - dy^2) / cy) to both sides. The wide blur rounds to whole grey values first
UNDER_ONCE = """b.y - a.y >= -(d.kernel_height // 2) and b.y - a.y < d.kernel_height - d.kernel_height // 2
    and abs(b.x - a.x) <= 5
    and case d.kernel when 'rect' then true when 'cross' then a.y = b.y or a.x = b.x
      else abs(b.x - a.x) <= round_even(5 * sqrt((d.kernel_height // 2) ** 2 - (b.y - a.y) ** 2) / (d.kernel_height // 2), 0) end"""
GROWN_ONCE = f"""select a.path, a.y, a.x,
    max(case when b.on_ = 1 and {UNDER_ONCE} then 1 else 0 end) as on_
  from {{source}} a join drawn d on a.path = d.path and d.rounds >= {{round}}
  join {{source}} b on a.path = b.path group by all"""
SIGMA_9 = 0.3 * ((9 - 1) * 0.5 - 1) + 0.8
ONCE = f"""with {PIXELS.replace('v > 0 ', '(v > 0.3)::int ')},
drawn as ({PARAMETERS['once']}),
first as ({GROWN_ONCE.format(source='px', round=1)}),
second as ({GROWN_ONCE.format(source='first', round=2)}),
grown as (
  select * from second union all
  select f.* from first f join drawn d on f.path = d.path where d.rounds = 1),
nine as (select unnest(range(-4, 5)) as d),
weights as (
  select * from (values (0, 0, 1.0::double), (3, -1, 0.25), (3, 0, 0.5), (3, 1, 0.25),
    (5, -2, 0.0625), (5, -1, 0.25), (5, 0, 0.375), (5, 1, 0.25), (5, 2, 0.0625),
    (7, -3, 0.03125), (7, -2, 0.109375), (7, -1, 0.21875), (7, 0, 0.28125), (7, 1, 0.21875),
    (7, 2, 0.109375), (7, 3, 0.03125)) w(size, d, w)
  union all select 9, d, exp(-d * d / (2 * {SIGMA_9} ** 2)) / sum(exp(-d * d / (2 * {SIGMA_9} ** 2))) over () from nine),
mirrored as (
  select g.path, g.y, g.x, wy.w * wx.w as w, d.threshold,
    7 - abs(7 - abs(g.y + wy.d)) as sy, 7 - abs(7 - abs(g.x + wx.d)) as sx
  from grown g join drawn d on g.path = d.path
  join weights wy on wy.size = d.blur join weights wx on wx.size = d.blur)
select m.path, m.y, m.x from mirrored m join grown s on s.path = m.path and s.y = m.sy and s.x = m.sx
group by m.path, m.y, m.x, m.threshold having floor(sum(m.w * s.on_) * 255 + 0.5) > m.threshold"""


@query("dilate_masks_once", "", ONCE)
def _(t):
    return ops.set_pixels(ops.dilate_masks(ops.dilation_parameters(masks(t, 0.3), "once")))


@query(
    "transform_report",
    "",
    """select count(*) filter (vec_id % 10 <> 3) as succeeded, count(*) filter (vec_id % 10 = 3) as failed,
  count(*) as total from embeddings""",
)
def _(t):
    # one mask in ten is cut short, so its size does not fit
    number = F.substring("path", 2, 20).cast("bigint")
    data = F.when(number % 10 == 3, F.unhex(F.lit("00FF"))).otherwise(F.col("data"))
    spoiled = masks(t).withColumn("data", data)
    done = ops.dilate_masks(ops.dilation_parameters(spoiled, "job"))
    return scoring.transform_report(done)


@query(
    "fit_mask",
    "",
    f"""with {PIXELS}, sized as (
  select 'm' || vec_id as path, 5 + vec_id % 9 as h, 12 as w from embeddings),
targets as (select path, h, w, unnest(range(h * w)) as i from sized),
placed as (
  select path, i // w as y, i % w as x, floor((i // w + 0.5) * 8 / h)::int as sy,
    floor((i % w + 0.5) * 8 / w)::int as sx from targets)
select p.path, p.y::int as y, p.x::int as x from placed p
join px on px.path = p.path and px.y = p.sy and px.x = p.sx where on_""",
)
def _(t):
    number = F.substring("path", 2, 20).cast("bigint")
    sized = masks(t).withColumns(
        {"image_height": (F.lit(5) + number % 9).cast("int"), "image_width": F.lit(12)}
    )
    return ops.set_pixels(ops.fit_masks(sized))


@query(
    "mask_from_bool",
    "",
    """select vec_id, array_to_string(
  list_transform(embedding, lambda v: case when v > 0 then 255 else 0 end), ',') as pixels from embeddings""",
)
def _(t):
    cells = F.transform("embedding", lambda v: v > 0)
    pixels = col.mask_from_bool(cells).cast("array<string>")
    return t.table("embeddings").select("vec_id", F.array_join(pixels, ",").alias("pixels"))


@query(
    "blank_frames",
    "",
    "select 'm' || vec_id as path, list_max(embedding) <= cast(0.3 as float) as blank from embeddings",
)
def _(t):
    frames = masks(t).drop("data")
    pixel = F.transform(
        "embedding", lambda x: F.when(x > F.lit(0.3).cast("float"), "FF").otherwise("00")
    )
    data = t.table("embeddings").select(
        F.concat(F.lit("m"), F.col("vec_id").cast("string")).alias("path"),
        F.unhex(F.array_join(pixel, "")).alias("data"),
    )
    return ops.blank_frames(data).select("path", "blank")


# twenty masks by hash, each with a kernel of 11 by 11, which reaches five to every side
PREVIEW = f"""with {PIXELS.replace('v > 0 ', '(v > 0)::int ')},
chosen as (
  select 'm' || vec_id as path from embeddings order by md5('42|m' || vec_id), path limit 20),
drawn as (
  select path, ['ellipse', 'rect', 'cross'][1 + {number('kernel')} % 3] as kernel, 11 as kernel_height,
    1 as rounds from chosen),
first as ({GROWN_ONCE.format(source='px', round=1)})
select f.path, string_agg(case when p.on_ = 1 then 'FF' else '00' end, '' order by f.y, f.x) as before,
  string_agg(case when f.on_ = 1 then 'FF' else '00' end, '' order by f.y, f.x) as after
from first f join px p on f.path = p.path and f.y = p.y and f.x = p.x group by f.path"""


@query("preview_dilation", "", PREVIEW)
def _(t):
    shown = ops.preview_dilation(masks(t), 20)
    return shown.select("path", F.hex("before").alias("before"), F.hex("after").alias("after"))


@query(
    "encode_png",
    "",
    "select 'm' || vec_id as path, '89504E470D0A1A0A' as signature from embeddings",
)
def _(t):
    encoded = ops.encode_png(masks(t))
    return encoded.select("path", F.substring(F.hex("png"), 1, 16).alias("signature"))


# tables of contents: each line's mask is a member, one in sixteen under another name
MEMBERS = f"""
  select 'train-masks-' || substr({LINE_KEY}, 1, 1) || '.zip' as archive,
         substr({LINE_KEY}, 1, 12) || case when substr({LINE_KEY}, 32, 1) = 'f' then '.bak' else '.png' end
           as member
  from {{lineitem}}"""


@query(
    "needed_in_archive",
    "segmentations",
    f"""with members as ({MEMBERS.format(lineitem='lineitem')})
select archive, member from members where member in (select MaskPath from segmentations)""",
)
def _(t):
    wanted = smp.needed_masks(t.view("segmentations"))
    return archives.needed_in_archive(t.sql(MEMBERS), wanted).select("archive", "member")


@query(
    "not_found_members",
    "segmentations",
    f"""with members as ({MEMBERS.format(lineitem='lineitem')})
select distinct MaskPath from segmentations where MaskPath not in (select member from members)""",
)
def _(t):
    return archives.not_found(t.sql(MEMBERS), smp.needed_masks(t.view("segmentations")))


@query(
    "found_members",
    "segmentations",
    f"""with members as ({MEMBERS.format(lineitem='lineitem')})
select MaskPath from segmentations intersect select member from members""",
)
def _(t):
    return archives.found_members(t.sql(MEMBERS), t.view("segmentations"))


# zip files of two hundred texts each: one text in fifty is damaged, one file in three is cut short
PER_ARCHIVE = 200


def zipped(t: Tables) -> DataFrame:
    """Archives with their bytes, built from the embeddings."""
    bits = F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0"))
    number = col.int_div(F.col("vec_id"), PER_ARCHIVE)
    texts = t.table("embeddings").select(
        "vec_id", number.alias("number"), F.array_join(bits, "").alias("body")
    )

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        held, number = io.BytesIO(), int(rows["number"].iat[0])
        with zipfile.ZipFile(held, "w") as z:
            for r in rows.sort_values("vec_id").itertuples(index=False):
                z.writestr(f"m{r.vec_id}.txt", r.body)
        data = bytearray(held.getvalue())
        with zipfile.ZipFile(io.BytesIO(bytes(data))) as z:
            for info in z.infolist():
                if int(info.filename[1:-4]) % 50 == 8:  # the first stored byte is another
                    data[info.header_offset + 30 + len(info.filename)] ^= 1
        content = bytes(data[:-30]) if number % 3 == 1 else bytes(data)
        return pd.DataFrame({"archive": [f"a{number}.zip"], "content": [content]})

    return texts.groupBy("number").applyInPandas(pack, "archive string, content binary")


@query(
    "extract_archive_members",
    "",
    f"""with m as (
  select 'a' || (vec_id // {PER_ARCHIVE}) || '.zip' as archive, 'm' || vec_id || '.txt' as member,
    array_to_string(list_transform(embedding, lambda v: case when v > 0 then '1' else '0' end), '') as body,
    (vec_id // {PER_ARCHIVE}) % 3 = 1 as unreadable, vec_id % 50 = 8 as damaged, vec_id % 2 = 0 as wanted
  from embeddings)
select archive, member, case when not damaged then body end as body, damaged as failed
from m where wanted and not unreadable
union all select distinct archive, null, null, true from m where unreadable""",
)
def _(t):
    folder = scratch_folder(t.spark, "archives")
    write_binary_files(zipped(t), folder, "archive", "content")
    wanted = t.sql(
        "select 'm' || cast(vec_id as string) || case when vec_id % 2 = 0 then '.txt' else '.none' end "
        "as MaskPath from {embeddings}"
    )
    content, failed = archives.extract_archive_members(archives.list_archives(t.spark, folder), wanted)
    read = content.select(
        "archive", F.col("path").alias("member"), F.col("content").cast("string").alias("body"),
        F.lit(False).alias("failed"),
    )
    return read.unionByName(
        failed.select("archive", "member", F.lit(None).cast("string").alias("body"), F.lit(True).alias("failed"))
    )
