"""The operators' input tables, seen as views of the test tables.

Every text is plain SQL that Spark and DuckDB both read, so that the check runs on
the same input. Names in braces are test tables; each view reads its whole table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

LINE_KEY = (
    "md5(cast(l_orderkey as string) || '|' || cast(l_linenumber as string) || '|' || "
    "cast(l_partkey as string) || '|' || cast(l_suppkey as string) || '|' || "
    "cast(cast(round(l_extendedprice * 100) as bigint) as string))"
)
MODEL = "'org' || cast({0} % 25 as string) || '/m' || cast({0} as string)"
CUSTOMER_MODEL = MODEL.format("c_custkey")
ORDER_MODEL = MODEL.format("o_custkey")

BINDINGS: dict[str, str] = {
    # two parts share a label, so the last one wins and odd labels have no class
    "classes": """
        select cast(p_partkey - p_partkey % 2 as string) as LabelName,
               p_name as ClassName, p_partkey as ord
        from {part}""",
    "segmentations": f"""
        select cast(l_orderkey as string) as ImageID,
               substr({LINE_KEY}, 1, 12) || '.png' as MaskPath,
               cast(l_partkey as string) as LabelName,
               {LINE_KEY} as ord
        from {{lineitem}}""",
    # every third image number, so that two of three images have no relationship
    "relationships": f"""
        select cast(l_orderkey * 3 as string) as ImageID,
               cast(l_partkey as string) as LabelName1,
               cast(l_suppkey as string) as LabelName2,
               l_returnflag as RelationshipLabel,
               {LINE_KEY} as ord
        from {{lineitem}}""",
    "narratives": """
        select cast(doc_id * 7 as string) as image_id, text as caption,
               'd' || lpad(cast(doc_id as string), 12, '0') as ord
        from {documents}
        union all
        select cast(conv_id * 5 as string), text,
               'c' || lpad(cast(conv_id as string), 12, '0') || lpad(cast(turn as string), 6, '0')
        from {conversations}""",
    "catalogue_rows": f"""
        select {CUSTOMER_MODEL} as id, c_custkey as ord,
               cast(floor(c_acctbal * 10) as bigint) as downloads,
               case c_custkey % 7
                 when 0 then 'diffusers,LoRA' when 1 then 'diffusers,peft,base_model:Org1/m'
                 when 2 then 'diffusers,base_model:adapter:org2/m' when 3 then 'diffusers'
                 when 4 then 'diffusers,Adapter' when 5 then 'diffusers,base_model:org3/x'
                 else 'text-to-image,diffusers' end as tags,
               case c_custkey % 5
                 when 1 then '"org9/b' || cast(c_nationkey as string) || '"'
                 when 2 then '["org8/b0","org8/b1"]' when 3 then '["org7/only"]'
                 when 4 then '[]' end as base_model,
               case when c_custkey % 6 = 0 then 'model_index.json,unet/w.bin'
                    else 'model_index.json,unet/w.safetensors' end as files,
               case c_mktsegment
                 when 'BUILDING' then 'text-to-video' when 'MACHINERY' then 'Text-to-Audio'
                 when 'HOUSEHOLD' then 'image-to-3D' when 'AUTOMOBILE' then 'text-to-image'
                 end as pipeline_tag,
               case when c_custkey % 11 = 0 then null
                    else cast(date '2023-01-01' + cast(c_custkey % 700 as int) as timestamp)
                    end as created_at
        from {{customer}}""",
    # one entry in four names a model that the catalogue no longer lists
    "registry": f"""
        select case when c_custkey % 4 = 3 then 'gone/m' || cast(c_custkey as string)
                    else {CUSTOMER_MODEL} end as model_id,
               case c_custkey % 4 when 0 then 'COMPLETED' when 1 then 'MODEL_FAULT'
                    else 'INFRASTRUCTURE_FAULT' end as status,
               case c_custkey % 8 when 2 then 'Node/GPU Out of Memory (Exit 12)'
                    when 6 then 'Data/Path Typo (Exit 10)' when 1 then 'No safetensors found'
                    when 3 then 'Generic Slurm/Job Failure (Exit 1)' end as reason,
               '1994-' || lpad(cast(1 + c_custkey % 12 as string), 2, '0') || '-15' as date,
               c_custkey as ord
        from {{customer}}""",
    "attempts": f"""
        select 'run' || cast(o_custkey as string) as run, o_orderkey as seq,
               {ORDER_MODEL} as model_id,
               case o_orderkey % 8 when 0 then 0 when 1 then 9 when 2 then 10 when 3 then 11
                    when 4 then 12 when 5 then 14 when 6 then 137 else 1 end as exit_code,
               case when o_orderstatus = 'F' then 'FileNotFoundError'
                    when o_orderstatus = 'P' then 'RuntimeError' else 'ValueError' end as error_class,
               case o_orderpriority
                 when '1-URGENT' then 'CUDA Out Of Memory while loading m' || cast(o_custkey as string)
                 when '2-HIGH' then 'No such file or directory: unet/Config.json'
                 when '3-MEDIUM' then 'No such file or directory: prompts.csv'
                 when '4-NOT SPECIFIED' then 'size mismatch in Dimension ' || cast(o_orderkey as string)
                 else 'Black Image after decode ' || cast(o_orderkey as string) end as message,
               o_orderdate as ts
        from {{orders}}""",
    "posts": """
        select cast(event_id as string) as id,
               case when event_id % 2 = 0 then event_type else upper(event_type) end as source,
               ts as created_utc,
               'https://i.example.com/' || cast(event_id as string) ||
                 case event_id % 5 when 0 then '.jpg' when 1 then '.PNG' when 2 then '.jpeg'
                      when 3 then '' else '.gif?x=.jpg1' end as url,
               event_id % 5 >= 3 as is_video,
               case when event_id % 5 = 3 then 'https://v.example.com/' || cast(event_id as string)
                    end as fallback_url
        from {events}""",
    # of what was seen before the 20th, one of three is known; all else has another id
    "known_posts": """
        select 'reddit_' || event_type || '_' || substr(cast(ts as string), 1, 10) || '_' ||
               case when event_id % 3 = 0 and ts < timestamp '2024-01-20 00:00:00' then '' else 'x' end ||
               cast(event_id as string) ||
               case event_id % 5 when 0 then '.jpg' when 1 then '.PNG' when 2 then '.jpeg'
                    else '_frame_0.jpg' end as filename,
               case when event_type = 'error' then 'real' else 'fake' end as label,
               case when event_id % 2 = 0 then event_type else upper(event_type) end as subreddit,
               case when event_id % 13 = 0 then 'not-a-date'
                    when event_type = 'view' then ''
                    else substr(cast(cast(ts as date) - 9 as string), 1, 10) end as post_date,
               cast(event_id as string) as reddit_id,
               false as packaged
        from {events}""",
    "prompt_pool": "select doc_id as id, text as prompt from {documents}",
    # five answer shapes: JSON, JSON in text, JSON with a tail, broken JSON, raw text
    "responses": """
        select conv_id, turn,
               case (conv_id + turn) % 5
                 when 0 then '{{"prompt": "' || escaped || '"}}'
                 when 1 then 'Sure: {{"prompt": "' || plain || '"}} - done'
                 when 2 then '{{"prompt": "' || escaped || '", "n": 1}} and more'
                 when 3 then '{{"prompt": "' || escaped || '"'
                 else '  ' || text || chr(10) end as response
        from (select conv_id, turn, text,
                     replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)),
                       chr(34), chr(92) || chr(34)), chr(10), chr(92) || 'n'), chr(9), ' ')
                       as escaped,
                     replace(replace(text, chr(34), chr(39)), chr(123), '(') as plain
              from {conversations}) c""",
    "scores": """
        select 'f' || cast(doc_id as string) || '.png' as filename,
               toxic * cast(0.7 as double) + quality * cast(0.05 as double) * (doc_id % 3) as nsfw,
               1 - toxic * cast(0.7 as double) as normal
        from {labels}""",
    # every seventeenth file is stored under another name, so it counts as missing
    "files": """
        select case when doc_id % 17 = 0 then 'other/' else '' end ||
               'f' || cast(doc_id as string) || '.png' as path, n_chars as length
        from {documents}""",
    "image_rows": """
        select 'f' || cast(doc_id as string) || '.png' as filename,
               case when doc_id % 2 = 0 then 'fake' when doc_id % 5 = 0 then null
                    else 'real' end as label,
               source as subreddit,
               case when doc_id % 9 = 0 then null else '2024-01-' ||
                 lpad(cast(1 + doc_id % 28 as string), 2, '0') end as post_date,
               cast(doc_id as string) as reddit_id, lang as model, doc_id
        from {documents}""",
    "generated_files": """
        select case o_orderkey % 6 when 4 then 'img_' else 'hf_' end ||
               'org' || cast(o_custkey % 25 as string) || '_m' || cast(o_custkey as string) ||
               case when o_orderkey % 6 = 0 then '_' || substr(cast(o_orderdate as string), 1, 10)
                    when o_orderkey % 6 = 1 then '_x' else '' end ||
               '_' || cast(o_orderkey as string) ||
               case when o_orderkey % 6 = 5 then '.jpg' else '.png' end as filename,
               o_orderkey
        from {orders}""",
    # names already written down before 1998; later ones stand in another folder
    "tracked_files": """
        select case when o_orderdate < timestamp '1998-01-01 00:00:00' then '' else 'later/' end ||
               case o_orderkey % 6 when 4 then 'img_' else 'hf_' end ||
               'org' || cast(o_custkey % 25 as string) || '_m' || cast(o_custkey as string) ||
               case when o_orderkey % 6 = 0 then '_' || substr(cast(o_orderdate as string), 1, 10)
                    when o_orderkey % 6 = 1 then '_x' else '' end ||
               '_' || cast(o_orderkey as string) ||
               case when o_orderkey % 6 = 5 then '.jpg' else '.png' end as filename
        from {orders}""",
    # masks that are on disk: one in sixteen has another name
    "mask_files": f"""
        select substr({LINE_KEY}, 1, 12) ||
               case when substr({LINE_KEY}, 32, 1) = '0' then '.tmp' else '.png' end as path,
               cast(l_quantity as bigint) as length
        from {{lineitem}}""",
    # one row per supplier: fewer than most quotas
    "short_rows": f"""
        select cast(l_suppkey as string) as ImageID, min(substr({LINE_KEY}, 1, 12) || '.png') as MaskPath,
               cast(l_suppkey as string) as LabelName, min({LINE_KEY}) as ord
        from {{lineitem}} group by l_suppkey""",
    # one row per part and flag: at sf0.01 fewer than the largest quotas, more than the others
    "part_rows": f"""
        select cast(l_partkey as string) as ImageID, min(substr({LINE_KEY}, 1, 12) || '.png') as MaskPath,
               l_returnflag as LabelName, min({LINE_KEY}) as ord
        from {{lineitem}} group by l_partkey, l_returnflag""",
    # feed posts in six shapes; the last has no url
    "feed_rows": """
        select event_id, case event_id % 6
          when 0 then '{{"id": "e' || n || '", "title": "t: ' || event_type || '", "created_at": "' ||
            substr(cast(ts as string), 1, 10) || '", "model": "m1", "encodings": {{"source": {{"path": ' ||
            '"https://videos.openai.com/' || n || '/source.mp4", "width": ' || u || ', "height": 5, ' ||
            '"duration_secs": 2.5}}}}, "user": {{"username": "u' || u || '"}}, "actions": {{"100": "' ||
            event_type || '", "200": "x"}}, "props": ' || props || '}}'
          when 1 then '{{"id": "", "post_id": "e' || n || '", "encodings": {{"source": {{"width": 7}}, ' ||
            '"md": {{"url": "https://cdn.example.com/' || n || '.webm"}}}}, "height": 3, "text": "text ' ||
            n || '"}}'
          when 2 then '{{"gen_id": "e' || n || '", "videoUrl": "https://cdn.example.com/' || n ||
            '.mp4", "prompt": "p ' || event_type || '"}}'
          when 3 then '{{"id": "e' || n || '", "media": {{"source": "https://cdn.example.com/' || n ||
            '.webp", "duration": 4, "width": ' || u || '}}, "author": {{"name": "a' || u || '"}}}}'
          when 4 then '{{"id": "outer", "generation": {{"generations": [{{"id": "e' || n ||
            '", "url": "https://videos.openai.com/v' || n || '", "title": " in/ner? "}}]}}}}'
          else '{{"id": "e' || n || '", "title": "nothing"}}' end as body
        from (select *, cast(event_id as string) as n, cast(user_id as string) as u from {events}) e""",
    # posts up to twelve generations deep; the deepest lie first in a list of 500, some have no url
    "deep_feed_rows": """
        select event_id, repeat('{{"id": "outer", "generation": ', cast(depth as int)) ||
          case when depth = 12 then '{{"generations": [' || inner_post ||
            repeat(', {{"generation": 0}}', 499) || ']}}' else inner_post end ||
          repeat('}}', cast(depth as int)) as body
        from (
          select event_id, event_id % 13 as depth, case when event_id % 17 = 0
            then '{{"id": "e' || cast(event_id as string) || '", "title": "nothing"}}'
            else '{{"id": "e' || cast(event_id as string) || '", "url": "https://cdn.example.com/' ||
              cast(event_id as string) || '.mp4"}}' end as inner_post
          from {events})""",
    # stored details: every second of the posts without a url has one under its id
    "feed_details": """
        select case when event_id % 2 = 1 then 'e' else 'none' end || cast(event_id as string) as key,
               '{{"id": "e' || cast(event_id as string) || '", "title": "from detail", "url": ' ||
               '"https://videos.openai.com/d' || cast(event_id as string) ||
               case when event_id % 4 = 1 then '"' else '", "model": "m2"' end || '}}' as body
        from {events}""",
    "videos": """
        select cast(conv_id as string) as id, cast(7 * count(*) as int) as total_frames
        from {conversations} group by conv_id""",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Tables:
    """The test tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        return self.sql(BINDINGS[name])

    def sql(self, text: str) -> DataFrame:
        used = [t for t in TABLES if re.search(rf"(?<!\{{)\{{{t}\}}", text)]
        return self.spark.sql(text, **{t: self.table(t) for t in used})


def with_views(names: str, text: str) -> str:
    """SQL for DuckDB: the named views as common table expressions, then the query."""
    tables = {t: t for t in TABLES}
    parts = [f"{n} as ({BINDINGS[n].format(**tables)})" for n in names.split()]
    return "with recursive " + ",\n".join(parts) + "\n" + text.strip()
