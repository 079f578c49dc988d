"""DuckDB views that the oracle queries share."""

from __future__ import annotations

MANIFEST_LINES = """
select p_partkey as line_no, case p_partkey % 5
  when 0 then concat('v', p_partkey)
  when 1 then concat('v', p_partkey, ',', p_name)
  when 2 then concat('v', p_partkey, ',', p_name, ',', p_type)
  when 3 then concat('v', p_partkey, ',,', p_type)
  else concat('v', p_partkey, ',', p_name, ',', p_type, ',', p_size, '.5') end as line
from part
"""

MANIFEST = """
select line_no as idx, f[1] as video_id,
  concat('https://www.youtube.com/watch?v=', f[1]) as url,
  case when len(f) > 1 then f[2] else concat('Video_', line_no) end as title,
  case when len(f) > 2 then f[3] else 'general' end as category,
  case when len(f) > 3 then coalesce(try_cast(f[4] as double), 0) else 0 end::double as duration
from (select line_no, string_split(line, ',') as f from manifest_lines)
"""

MEDIA_FILES = """
select page_id, concat('hdfs://host:9000/user/',
  case page_id % 4 when 0 then 'high_quality' when 1 then 'medium_quality'
    when 2 then 'low_quality' else 'raw' end,
  '/clip_', page_id,
  case page_id % 9 when 0 then '.mp4' when 1 then '.avi' when 2 then '.mov' when 3 then '.MKV'
    when 4 then '.flv' when 5 then '.webm' when 6 then '.txt' when 7 then '.part.mp4'
    else '' end) as path,
  case when page_id % 10 = 0 then 0 else length(html) * 4099 end as length
from pages
"""

LISTING = """
select regexp_replace(name, '\\.[^.]*$', '') as video_id, path, length as file_size,
  length > 0 as is_valid, case when length = 0 then 'Empty file' end as error_message
from (select *, regexp_extract(path, '([^/]*)$', 1) as name from media_files)
where regexp_matches(lower(name), '\\.(mp4|avi|mov|mkv|flv|webm)$')
"""

PROBE = """
select cast(o_custkey as varchar) as video_id, concat('/user/raw/', o_orderkey, '.mp4') as path,
  cast((o_orderkey * 37) % 4000 as double) as duration,
  case o_orderkey % 7 when 0 then '1920x1080' when 1 then '1280x720' when 2 then '640x480'
    when 3 then '854x480' when 4 then '320x240' when 5 then '0x0' else 'unknown' end
    as resolution,
  cast(case o_orderkey % 8 when 0 then 0.0 when 1 then 10.0 when 2 then 15.0 when 3 then 24.0
    when 4 then 29.97 when 5 then 60.0 when 6 then 120.0 else 144.0 end as double) as fps,
  case o_orderkey % 4 when 0 then 'h264' when 1 then 'vp9' when 2 then 'hevc' else 'unknown' end
    as codec,
  cast(case o_orderkey % 3 when 0 then (o_orderkey * 7919) % 9000000
    when 1 then (o_orderkey * 131) % 500000 else 0 end as bigint) as bitrate,
  o_orderkey % 2 = 0 as has_audio, o_orderkey * 1009 as file_size,
  case when o_orderstatus = 'P' then 'error: x' else 'success' end as processing_status
from orders
"""

CHECKED = """
select *, case when quality_score >= 80 then 'high' when quality_score >= 60 then 'medium'
    when quality_score >= 40 then 'low' else 'poor' end as quality_level,
  duration between 10 and 3600 as is_valid_duration,
  resolution not like '%unknown%' and resolution not like '%0x0%' as is_valid_resolution,
  fps between 15 and 120 as is_valid_fps,
  duration between 10 and 3600 and resolution not like '%unknown%'
    and resolution not like '%0x0%' and fps between 15 and 120 as passes_all_checks
from (select *, cast(
  case when duration between 30 and 600 then 25 when duration > 600 and duration <= 1800 then 20
    when duration > 0 and duration < 30 then 10 else 0 end
  + case when resolution like '%1080%' then 30 when resolution like '%720%' then 25
    when resolution like '%480%' then 20 else 10 end
  + case when fps between 24 and 30 then 20 when fps > 30 and fps <= 60 then 25
    when fps > 0 then 10 else 0 end
  + case when bitrate // 1000 between 500 and 5000 then 25 when bitrate // 1000 > 5000 then 20
    when bitrate // 1000 > 0 then 10 else 0 end as double) as quality_score from probe)
"""

DEDUPED = """
select * from (select *, row_number() over (partition by video_id order by path) as rn
  from checked where processing_status = 'success' and passes_all_checks) where rn = 1
"""

CLEANED = "select * from deduped where quality_score >= 40"

PROBE_JSON = """
select path, case cast(file_size % 29 as int) when 0 then 'not json' when 1 then '{"streams":[]}'
  when 2 then '{"format":{"duration":"N/A"},"streams":[]}' when 3 then '{"format":{"duration":"5.5"'
  when 4 then '{"format":' when 5 then '{not json}' when 6 then concat(whole, ' garbage')
  when 7 then '{"format":{"duration":"5.5"},"streams":"none"}'
  when 8 then replace(whole, '"height":480', '"height":"abc"')
  when 9 then replace(whole, '"height":480', '"height":99999999999')
  when 10 then concat(chr(10), chr(9), ' ', whole, chr(10)) else whole end as probe
from (select path, file_size, concat('{"format":{"duration":"', cast(duration as varchar), '","bit_rate":"',
    cast(bitrate as varchar), '"},"streams":[',
    case when has_audio then '{"codec_type":"audio","codec_name":"aac"},' else '' end,
    '{"codec_type":"video","codec_name":"', codec, '","width":',
    cast(640 + file_size % 3 as varchar), ',"height":480,"r_frame_rate":"',
    case cast(file_size % 4 as int) when 0 then '30000/1001' when 1 then '25/1' when 2 then '0/0'
      else '24' end, '"}]}') as whole
  from probe)
"""

PARSED = """
select path, failed, case when failed then 'parse_error' else 'parsed' end as processing_status,
  case when failed then 0 else coalesce(try_cast(d as double), 0) end::double as duration,
  case when failed then 'unknown' else concat(coalesce(v->>'$.width', '0'), 'x',
    coalesce(v->>'$.height', '0')) end as resolution,
  case when failed or len(r) <> 2 or try_cast(r[2] as int) = 0 then 0
    else coalesce(try_cast(r[1] as double) / try_cast(r[2] as double), 0) end::double as fps,
  case when failed then 'unknown' else coalesce(v->>'$.codec_name', 'unknown') end as codec,
  case when failed then 0 else coalesce(try_cast(b as bigint), 0) end::bigint as bitrate,
  case when failed then false else coalesce(len(list_filter(streams,
    lambda s: s->>'$.codec_type' = 'audio')) > 0, false) end as has_audio
from (select *, string_split(v->>'$.r_frame_rate', '/') as r,
    j is null or (d is not null and try_cast(d as double) is null)
      or (b is not null and try_cast(b as bigint) is null)
      or coalesce(json_type(j->'$.streams') <> 'ARRAY', false)
      or (v->>'$.width' is not null and try_cast(v->>'$.width' as int) is null)
      or (v->>'$.height' is not null and try_cast(v->>'$.height' as int) is null) as failed
  from (select *, j->>'$.format.duration' as d, j->>'$.format.bit_rate' as b,
      list_filter(streams, lambda s: s->>'$.codec_type' = 'video')[1] as v
    from (select *, try_cast(j->'$.streams' as json[]) as streams
      from (select path, case when json_valid(probe) then cast(probe as json) end as j
        from probe_json))))
"""

JOB_PROBE = """
select f.video_id, f.path, f.file_size,
  case when f.file_size > 0 and p.path is not null then p.duration else 0 end as duration,
  case when f.file_size > 0 and p.path is not null then p.resolution else 'unknown' end as resolution,
  case when f.file_size > 0 and p.path is not null then p.fps else 0 end as fps,
  case when f.file_size > 0 and p.path is not null then p.bitrate else 0 end as bitrate,
  case when f.file_size = 0 then 'invalid: Empty file' when p.path is null then 'error: no probe output'
    when p.processing_status = 'parsed' then 'success' else p.processing_status end as processing_status
from (select video_id, path as raw, file_size // 1009 as number,
    concat('/user/raw/', file_size // 1009, '/', video_id, '.mp4') as path,
    case when file_size // 1009 % 11 = 0 then 0 else file_size end as file_size from probe) f
left join parsed p on f.raw = p.path and f.number % 13 <> 0
"""

TRANSCRIPTS = """
select doc_id,
  concat('hdfs://host:9000/user/audio_files/video_', doc_id, '.wav') as filename, transcript,
  cast(n_chars % 17 as int) as num_segments, n_chars / cast(15 as double) as duration
from (select doc_id, text as transcript, n_chars from documents
  union all select -1 - doc_id, case when doc_id % 10 = 0
      then concat('[Audio contains approximately ', n_chars % 17, ' speech segments]')
    else '' end, n_chars from documents where doc_id % 10 < 2)
"""

WHITE_SPACE = (
    "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}"
    "\\x{205f}\\x{3000}]+"
)

TOKENS = f"""
select doc_id, transcript, list_filter(regexp_split_to_array(
  translate(lower(transcript), '.,!?;:', '      '), '{WHITE_SPACE}'), lambda t: t <> '') as toks,
  len(list_filter(regexp_split_to_array(transcript, '{WHITE_SPACE}'), lambda t: t <> ''))
    as num_words,
  transcript <> '' and not starts_with(transcript, '[') as has_content
from transcripts
"""

STOP_LIST = (
    "'the','is','at','which','on','a','an','as','are','was','were','been','be','have','has',"
    "'had','do','does','did','but','if','or','and','to','of','in','for','with'"
)

KEYWORD_ROWS = f"""
select * from (select *, row_number() over (partition by doc_id order by frequency desc, pos) as rnk
  from (select doc_id, word, count(*) as frequency, min(pos) as pos
    from (select doc_id, unnest(toks) as word, unnest(range(len(toks))) as pos from tokens
      where has_content)
    where word not in ({STOP_LIST}) group by doc_id, word)) where rnk <= 10
"""

KEYWORD_LISTS = """
select doc_id, string_agg(word || ':' || frequency, ',' order by rnk) as keywords,
  string_agg(word, ', ' order by rnk) filter (where rnk <= 5) as first_words
from keyword_rows group by doc_id
"""

TFIDF = """
with tf as (select doc_id, term, count(*) as n, any_value(l) as l
  from (select doc_id, len(toks) as l, unnest(toks) as term from tokens
    where not starts_with(transcript, '[')) group by doc_id, term),
df as (select term, count(*) as d from tf group by term),
n as (select count(*) as n from transcripts where not starts_with(transcript, '['))
select doc_id, tf.term, tf.n / tf.l::double as tf, ln(n.n / (d + 1)::double) as idf,
  tf.n / tf.l::double * ln(n.n / (d + 1)::double) as score
from tf join df on tf.term = df.term cross join n
"""

TFIDF_TOP = """
select * from (select *, row_number() over (partition by doc_id 
  order by floor(score * 1e9 + 0.5) desc, term)
  as rnk from tfidf) where rnk <= 5
"""

POSITIVE = (
    "'good','great','excellent','amazing','wonderful','fantastic','love','best','perfect',"
    "'awesome'"
)
NEGATIVE = (
    "'bad','poor','terrible','horrible','worst','awful','hate','disappointing','problem','issue'"
)

SENTIMENTS = f"""
select doc_id, case when not has_content or p = q then 'neutral' when p > q then 'positive'
  else 'negative' end as sentiment
from (select doc_id, has_content,
  len(list_filter([{POSITIVE}], lambda w: contains(lower(transcript), w))) as p,
  len(list_filter([{NEGATIVE}], lambda w: contains(lower(transcript), w))) as q from tokens)
"""

TEXT_RESULTS = """
select t.doc_id, t.filename, t.transcript, t.duration, t.num_segments, s.sentiment,
  coalesce(k.keywords, '') as keywords,
  case when not c.has_content then 'No audio content detected.'
    when k.keywords is not null then printf('This %.1f second audio segment discusses topics '
      || 'related to: %s. Approximate word count: %d.', t.duration, k.first_words, c.num_words)
    else printf('Audio segment of %.1f seconds. Approximate word count: %d.', t.duration,
      c.num_words) end as summary
from transcripts t join tokens c on t.doc_id = c.doc_id join sentiments s on t.doc_id = s.doc_id
left join keyword_lists k on t.doc_id = k.doc_id
"""

FRAMES = """
select concat('video_', label, '.mp4') as video_name,
  row_number() over (partition by label order by vec_id) - 1 as frame_number,
  cast(row_number() over (partition by label order by vec_id) - 1 as double) as timestamp,
  vec_id, (vec_id * 7) % 25 as cluster, embedding as features
from embeddings
"""

FRAMES_LONG = """
select video_name, frame_number, timestamp, cluster, vec_id, dim, features[dim + 1]::double as v
from (select *, unnest(range(len(features))) as dim from frames)
"""

DISTANCES = """
with c as (select cluster, dim, avg(v) as center from frames_long group by cluster, dim)
select video_name, frame_number, any_value(timestamp) as timestamp, f.cluster,
  round(sqrt(sum((v - center) * (v - center))), 6) as distance
from frames_long f join c on f.cluster = c.cluster and f.dim = c.dim
group by video_name, frame_number, f.cluster
"""

KEYFRAMES_DET = """
select * from (select *, row_number() over
  (partition by cluster order by distance, video_name, frame_number) as rn from distances)
where rn = 1
"""

STATS = """
select k.video_name, num_keyframes, first_keyframe_time, last_keyframe_time,
  clusters_represented, original_frame_count,
  original_frame_count / num_keyframes::double as compression_ratio
from (select video_name, count(*) as num_keyframes, min(timestamp) as first_keyframe_time,
    max(timestamp) as last_keyframe_time,
    string_agg(cluster::varchar, ',' order by cluster) as clusters_represented
  from keyframes_det group by video_name) k
join (select video_name, count(*) as original_frame_count from frames group by video_name) f
  on k.video_name = f.video_name
"""

DOCUMENTS = """
select v.video_name, v.num_keyframes, v.keyframe_details, t.transcript, t.summary, t.sentiment,
  t.keywords, t.duration
from (select video_name, count(*) as num_keyframes,
    string_agg(concat(frame_number, '@', timestamp, '#', cluster), ',' order by frame_number)
      as keyframe_details
  from keyframes_det group by video_name) v
left join text_results t on v.video_name = regexp_replace(
  regexp_extract(t.filename, '([^/]*)$', 1), '\\.wav$', '.mp4')
"""

FINAL_SUMMARIES = """
select v.video_name, replace(v.video_name, '.mp4', '_summary.mp4') as summary_video_name,
  concat('/summaries/', replace(v.video_name, '.mp4', '_summary.mp4'))
    as hdfs_path, num_keyframes, num_keyframes * 2 as duration_seconds, r.summary as text_summary,
  r.sentiment, r.keywords, r.doc_id
from (select video_name, count(*) as num_keyframes from keyframes_det group by video_name) v
left join (select video_name, min(filename) as filename from
    (select distinct video_name from keyframes_det)
  join transcripts on contains(filename, replace(video_name, '.mp4', '')) group by video_name) m
  on v.video_name = m.video_name
left join text_results r on m.filename = r.filename
"""

SMOOTHED = """
select video_name, frame_number, timestamp, dim, case
    when b is not null and a is not null
      then (exp(-0.5) * b + v + exp(-0.5) * a) / (1 + 2 * exp(-0.5))
    when b is null and a is not null then a else v end as value
from (select *, lag(v) over w as b, lead(v) over w as a from frames_long
  window w as (partition by video_name, dim order by timestamp, frame_number))
"""

SCALED = """
select video_name, frame_number, any_value(timestamp) as timestamp, list(x order by dim) as vec,
  md5(string_agg(floor(x * 1e4)::bigint::varchar, ',' order by dim)) as mark,
  string_agg(floor(value * 1e6 + 0.5)::bigint::varchar, ',' order by dim) as smoothed
from (select *, case when s = 0 then 0 else (value - m) / s end as x
  from (select *, avg(value) over (partition by dim) as m,
    stddev_samp(value) over (partition by dim) as s from smoothed))
group by video_name, frame_number
"""


def _kmeans_views(scaled: str, prefix: str = "", passes: int = 20) -> dict:
    """Plain K-means passes over all centres of a view of scaled vectors; passes that change
    nothing more cost little."""
    views = {
        f"{prefix}centers_0": (
            f"""select row_number() over (order by mark) - 1 as cluster, center
            from (select mark, arg_min(vec, (video_name, frame_number)) as center from {scaled} group by mark)
            qualify cluster < (select greatest(5, floor(count(*) * 0.1::double)::bigint) from {scaled})""",
            (scaled,),
        )
    }
    for n in range(passes + 1):
        views[f"{prefix}placed_{n}"] = (
            f"""select * from (select r.*, cluster,
                floor(list_distance(vec, center) * 1e9 + 0.5) / 1e9 as distance
              from {scaled} r cross join {prefix}centers_{n})
            qualify row_number() over (partition by video_name, frame_number order by distance, cluster) = 1""",
            (scaled, f"{prefix}centers_{n}"),
        )
        views[f"{prefix}centers_{n + 1}"] = (
            f"""select cluster, coalesce(mean, center) as center from {prefix}centers_{n}
            left join (select cluster, list(x order by dim) as mean
              from (select cluster, dim, floor(avg(vec[dim + 1]) * 1e9 + 0.5) / 1e9 as x
                from (select cluster, vec, unnest(range(len(vec))) as dim from {prefix}placed_{n})
                group by cluster, dim) group by cluster) using (cluster)""",
            (f"{prefix}placed_{n}",),
        )
    return views | {f"{prefix}clusters": (f"select * from {prefix}placed_{passes}", (f"{prefix}placed_{passes}",))}


PIXELS = """
select vec_id, d, d // 8 as r, d % 8 as c, floor((embedding[d + 1]::double + 1) * 127.5) as level
from (select vec_id, embedding, unnest(range(64)) as d from embeddings)
"""

EDGES = """
with k(kernel, dr, dc, w) as (values
  ('horizontal',0,0,-1),('horizontal',0,1,-1),('horizontal',0,2,-1),
  ('horizontal',2,0,1),('horizontal',2,1,1),('horizontal',2,2,1),
  ('vertical',0,0,-1),('vertical',0,2,1),('vertical',1,0,-1),('vertical',1,2,1),
  ('vertical',2,0,-1),('vertical',2,2,1),
  ('diagonal',0,1,1),('diagonal',0,2,1),('diagonal',1,0,-1),('diagonal',1,2,1),
  ('diagonal',2,0,-1),('diagonal',2,1,-1))
select vec_id, kernel, r - dr as r, c - dc as c, sum(w * level / 255.0::double) as value
from pixels, k where r - dr between 0 and 5 and c - dc between 0 and 5
group by vec_id, kernel, r - dr, c - dc
"""

TEXTURE = """
select e.vec_id, mean_h, std_h, mean_v, std_v, mean_d, std_d, max_h, max_v, max_d,
  mean_gray, std_gray, min_gray, max_gray
from (select vec_id,
    avg(value) filter (where kernel = 'horizontal') as mean_h,
    stddev_pop(value) filter (where kernel = 'horizontal') as std_h,
    avg(value) filter (where kernel = 'vertical') as mean_v,
    stddev_pop(value) filter (where kernel = 'vertical') as std_v,
    avg(value) filter (where kernel = 'diagonal') as mean_d,
    stddev_pop(value) filter (where kernel = 'diagonal') as std_d,
    max(value) filter (where kernel = 'horizontal') as max_h,
    max(value) filter (where kernel = 'vertical') as max_v,
    max(value) filter (where kernel = 'diagonal') as max_d
  from edges group by vec_id) e
join (select vec_id, avg(level / 255.0::double) as mean_gray,
    stddev_pop(level / 255.0::double) as std_gray, min(level) / 255.0::double as min_gray,
    max(level) / 255.0::double as max_gray from pixels group by vec_id) g on e.vec_id = g.vec_id
"""

COLOR_LEVELS = """
select vec_id, d, r as row, c as col, level::int as b, 255 - level::int as g, level::int * 2 % 256 as r from pixels
"""

COLOR_GRAY = """
select vec_id, d, row as r, col as c, (114 * b + 587 * g + 299 * r + 500) // 1000 as level from color_levels
"""

COLOR_FEATURES = """
select vec_id, dim, coalesce(case when dim between 96 and 108 then stats[dim - 95] else n end, 0)::float::double as value
from (select vec_id, [mean_h, std_h, mean_v, std_v, mean_d, std_d, max_h, max_v, max_d,
    mean_gray, std_gray, min_gray, max_gray] as stats, unnest(range(512)) as dim from color_texture)
left join (select vec_id, dim, count(*)::double as n
  from (select vec_id, unnest([b // 8, 32 + g // 8, 64 + r // 8])::bigint as dim from color_levels)
  group by vec_id, dim) using (vec_id, dim)
"""

PIXEL_FRAMES = """
select video_name, frame_number, timestamp, dim, value as v from frames join color_features using (vec_id)
"""

SIGNAL = """
select user_id as clip, row_number() over (partition by user_id order by ts, event_id) - 1 as i,
  value as x from events
"""

# Frames of 40 samples with a hop of 16.
FRAMED = """
select clip, frame, i - frame * 16 as offs, x
from (select clip, i, x, unnest(range(greatest(0, (i - 40 + 16) // 16), i // 16 + 1)) as frame, n
  from (select *, max(i) over (partition by clip) + 1 as n from signal))
where frame * 16 + 40 <= ((n + 15) // 16) * 16 and i - frame * 16 between 0 and 39
"""

ENERGIES = """
select clip, frame, count(*) as samples, sum(x * x) as energy from framed group by clip, frame
"""

MASK = """
select *, energy > threshold as speech
from (select *, 0.5 * avg(energy) over (partition by clip) as threshold from energies)
"""

SEGMENTS = """
select clip, min(frame) as seg_start, max(frame) + 1 as seg_end
from (select clip, frame, frame - row_number() over (partition by clip order by frame) as island
  from mask where speech) group by clip, island
"""

# WAV clips: 64 samples at most, 400 samples a second, so frames of 10 with a hop of 4.
WAVS = """
select concat(clip, '/', i // 64) as clip, i % 64 as j, floor(x * (
    select least(64::double, floor(32767 / greatest(max(abs(value)), 1))) from events))
    / 32768.0::double as s
from signal
"""

WAV_FRAMES = """
with e as (select clip, j, s - 0.97 * coalesce(lag(s) over (partition by clip order by j), 0) as y,
  count(*) over (partition by clip) as n from wavs)
select clip, frame, j - frame * 4 as o,
  y * (0.54 - 0.46 * cos(2 * pi() * (j - frame * 4) / 9)) as y
from (select *, unnest(range(greatest(0, (j - 10 + 4) // 4), j // 4 + 1)) as frame from e)
where frame * 4 + 10 <= ((n + 3) // 4) * 4 and j - frame * 4 between 0 and 9
"""

SPECTRUM = """
with b as (select bin, o, cos(2 * pi() * bin * o / 512) as c, sin(2 * pi() * bin * o / 512) as s
  from (select unnest(range(257)) as bin), (select unnest(range(10)) as o))
select clip, frame, bin, sum(y * c) ** 2 + sum(y * s) ** 2 as power
from wav_frames f join b on f.o = b.o group by clip, frame, bin
"""

MEL = """
with p as (select id, floor(513 * 700 * (pow(10, id * 2595 * log10(1 + 200 / 700.0::double)
    / 27 / 2595) - 1) / 400) as edge from (select unnest(range(28)) as id)),
t as (select id as filter, edge as l, lead(edge) over (order by id) as m,
  lead(edge, 2) over (order by id) as r from p),
w as (select filter, bin, case when bin < m then (bin - l) / (m - l) else (r - bin) / (r - m) end
  as weight from t, (select unnest(range(257)) as bin)
  where filter < 26 and bin >= l and bin < r)
select clip, frame, filter, sum(power * weight) as energy
from spectrum s join w on s.bin = w.bin group by clip, frame, filter
"""

MFCC = """
select clip, frame, k, sum(ln(case when energy = 0 then 2.220446049250313e-16 else energy end)
  * cos(pi() * k * (2 * filter + 1) / 52)) as mfcc
from mel, (select unnest(range(13)) as k) group by clip, frame, k
"""

# Each view with the views it reads, in an order that resolves.
VIEWS = {
    "manifest_lines": (MANIFEST_LINES, ()),
    "manifest": (MANIFEST, ("manifest_lines",)),
    "media_files": (MEDIA_FILES, ()),
    "listing": (LISTING, ("media_files",)),
    "probe": (PROBE, ()),
    "checked": (CHECKED, ("probe",)),
    "deduped": (DEDUPED, ("checked",)),
    "cleaned": (CLEANED, ("deduped",)),
    "probe_json": (PROBE_JSON, ("probe",)),
    "parsed": (PARSED, ("probe_json",)),
    "job_probe": (JOB_PROBE, ("probe", "parsed")),
    "job_checked": (CHECKED.replace("from probe)", "from job_probe)"), ("job_probe",)),
    "transcripts": (TRANSCRIPTS, ()),
    "tokens": (TOKENS, ("transcripts",)),
    "keyword_rows": (KEYWORD_ROWS, ("tokens",)),
    "keyword_lists": (KEYWORD_LISTS, ("keyword_rows",)),
    "tfidf": (TFIDF, ("tokens",)),
    "tfidf_top": (TFIDF_TOP, ("tfidf",)),
    "sentiments": (SENTIMENTS, ("tokens",)),
    "text_results": (TEXT_RESULTS, ("sentiments", "keyword_lists")),
    "frames": (FRAMES, ()),
    "frames_long": (FRAMES_LONG, ("frames",)),
    "distances": (DISTANCES, ("frames_long",)),
    "keyframes_det": (KEYFRAMES_DET, ("distances",)),
    "smoothed": (SMOOTHED, ("frames_long",)),
    "scaled": (SCALED, ("smoothed",)),
    **_kmeans_views("scaled"),
    "stats": (STATS, ("keyframes_det",)),
    "video_docs": (DOCUMENTS, ("keyframes_det", "text_results")),
    "final_summaries": (FINAL_SUMMARIES, ("keyframes_det", "text_results")),
    "pixels": (PIXELS, ()),
    "edges": (EDGES, ("pixels",)),
    "texture": (TEXTURE, ("edges",)),
    "color_levels": (COLOR_LEVELS, ("pixels",)),
    "color_gray": (COLOR_GRAY, ("color_levels",)),
    "color_edges": (EDGES.replace("pixels", "color_gray"), ("color_gray",)),
    "color_texture": (
        TEXTURE.replace("edges", "color_edges").replace("pixels", "color_gray"),
        ("color_edges", "color_gray"),
    ),
    "color_features": (COLOR_FEATURES, ("color_texture", "color_levels")),
    "pixel_frames": (PIXEL_FRAMES, ("frames", "color_features")),
    "pixel_smoothed": (SMOOTHED.replace("frames_long", "pixel_frames"), ("pixel_frames",)),
    "pixel_scaled": (SCALED.replace("smoothed))", "pixel_smoothed))"), ("pixel_smoothed",)),
    **_kmeans_views("pixel_scaled", "pixel_"),
    "signal": (SIGNAL, ()),
    "framed": (FRAMED, ("signal",)),
    "energies": (ENERGIES, ("framed",)),
    "mask": (MASK, ("energies",)),
    "segments": (SEGMENTS, ("mask",)),
    "wavs": (WAVS, ("signal",)),
    "wav_frames": (WAV_FRAMES, ("wavs",)),
    "spectrum": (SPECTRUM, ("wav_frames",)),
    "mel": (MEL, ("spectrum",)),
    "mfcc": (MFCC, ("mel",)),
}


def with_views(query: str, *views: str) -> str:
    """The query behind the definitions of the views it reads and of those they read."""
    needed: set[str] = set()
    waiting = list(views)
    while waiting:
        name = waiting.pop()
        if name not in needed:
            needed.add(name)
            waiting.extend(VIEWS[name][1])
    if not needed:
        return query
    parts = [f"{name} as materialized ({VIEWS[name][0]})" for name in VIEWS if name in needed]
    return "with " + ",\n".join(parts) + "\n" + query
