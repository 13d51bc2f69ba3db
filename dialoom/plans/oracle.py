"""DuckDB SQL of the core queries, written independently of the DataFrame operators."""

from __future__ import annotations

from dialoom.functions.text import CONTENT, OBJECTIONS, PUNCTUATION_ONLY, WHITE
from dialoom.operators.events import PAGE_END, PAGE_TOP
from dialoom.operators.persona import UNSPACED
from dialoom.sources.books import INLINE_SPACE, LINE_END

from .adapters import PAGE_HEAD, PAGE_TAIL, SHOWN

_EV = """ev as (
    select video_id, event_id, min(start_ms) start_ms, max(end_ms) end_ms, max(speaker) speaker, max("text") "text",
           max(confidence) confidence, bool_or(review_required) review_required, max(source_file) source_file
    from dialogue_events group by all)"""
_WORK = _EV + """, ew as (select ev.*, r.work_id, r.kind, r.status from ev join video_runs r using (video_id))"""
_NUM = _EV + r""", num as (select *, cast(regexp_extract(event_id, '(\d+)$', 1) as bigint) "number" from ev)"""
_FRAMES = _NUM + f""", frames as (
    select video_id, "number", "number" * 6.0::double + i * 0.5::double ts, confidence, {SHOWN} "text"
    from (select *, length("text") n from num), (select unnest(range(12)) i))
, seen as (select * from frames where "text" is not null)"""
_FRAGMENTS = _NUM + """, fr as (
    select video_id, event_id, start_ms, end_ms, speaker, "text" from num
    union all
    select video_id, event_id || 'a', start_ms - 1000, start_ms - 100, speaker, left("text", cast(length("text") // 2 as int)) from num where "number" % 3 = 0 and length("text") >= 8)"""
_STRIP = lambda x: f"regexp_replace({x}, '^{WHITE}+|{WHITE}+$', '', 'g')"
_ASCII = lambda x: f"replace(translate({x}, '（）。，！？：；～—　', '().,!?:;~- '), '…', '...')"
_COUNT = lambda x: f"len(regexp_extract_all({x}, '{CONTENT}'))"
_TIMES = lambda x, c: f"(length({x}) - length(replace({x}, '{c}', '')))"
_STAMP = lambda ms: f"printf('[%02d:%02d:%02d]', ({ms} // 1000) // 3600, (({ms} // 1000) // 60) % 60, ({ms} // 1000) % 60)"
_SRT = lambda ms: f"printf('%02d:%02d:%02d,%03d', ({ms} // 1000) // 3600, (({ms} // 1000) // 60) % 60, ({ms} // 1000) % 60, {ms} % 1000)"
_LINE = f"""{_STAMP('start_ms')} || case when coalesce(speaker, '') <> '' then ' ' || speaker || ': ' else ' ' end || "text" """
_HUD = lambda x: (
    f"""({x} <> '' and (regexp_matches({x}, '^(?:\\d|{WHITE}|/)+$') or regexp_matches({x}, '^\\d+{WHITE}*/{WHITE}*\\d+')
    or regexp_matches({x}, '^[A-Z0-9]{{2,}}$') or regexp_matches({x}, '^[A-Z]{{2,}}{WHITE}*\\d') or (length({x}) <= 3 and regexp_matches({x}, '\\d'))))""")
_ESC = lambda x: f"""replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')"""
_GOLD = _EV + """, gold as (
    select ev.video_id, ev.event_id gold_id, ev.start_ms, ev.end_ms, c."text" from ev join (
        select video_id, event_id, max("text") "text" from corrections where accepted and "text" is not null group by all) c using (video_id, event_id)),
m as (
    select g.video_id, g.gold_id, g."text" gold_text, e.event_id, e."text", least(e.end_ms, g.end_ms) - greatest(e.start_ms, g.start_ms) overlap_ms,
           row_number() over (partition by g.video_id, g.gold_id order by least(e.end_ms, g.end_ms) - greatest(e.start_ms, g.start_ms) desc nulls last, e.start_ms, e.event_id desc) rn
    from gold g left join ev e on e.video_id = g.video_id and e.start_ms < g.end_ms and g.start_ms < e.end_ms)"""
_PIXEL = lambda name: f"""cast(floor({name}.x * 1280 - 200) as int) x, cast(floor({name}.y * 720) as int) y, cast(floor({name}.w * 1600) as int) width, cast(floor({name}.h * 900) as int) height"""
_SIG = """sig as (select user_id "key", epoch_us(ts) / 1000000 ts, "value", event_id from events)"""
_FIRST = _EV + """, f as (select video_id, start_ms / 1000 ts, min(event_id) event_id from ev group by all)"""

#: Aliases with their canonical name (the last one listed has it), special names, and all known names of each work.
_NAMES = """al as (select work_id, alias, arg_max(canonical, k) canonical from (
        select work_id, k, map_keys(speaker_aliases)[k] canonical, unnest(map_values(speaker_aliases)[k]) alias from (select *, unnest(range(1, len(map_keys(speaker_aliases)) + 1)) k from work_configs))
        where alias is not null group by all),
    sp as (select work_id, k alias, max(special_speakers[k]) special from (select *, unnest(map_keys(special_speakers)) k from work_configs) group by all having max(special_speakers[k]) is not null),
    known as (select work_id, unnest(map_keys(speaker_aliases)) n from work_configs union select work_id, alias from al union select work_id, unnest(map_keys(special_speakers)) from work_configs)"""
#: Rows (work_id, speaker, text) with the name at the beginning of a text without a speaker: hit, its meaning, the rest of the text.
_LABELLED = lambda rows: f"""select y.*, k.n is not null and y.label is not null hit, coalesce(sp.special, al.canonical, y.label) meant from (
        select *, case when speaker is null and instr(whole, ' ') > 0 and rest <> '' then {_STRIP("split_part(whole, ' ', 1)")} end label from (
            select *, {_STRIP("substr(whole, instr(whole, ' ') + 1)")} rest from (select *, {_STRIP('"text"')} whole from {rows}))) y
        left join known k on k.work_id = y.work_id and k.n = y.label left join sp on sp.work_id = y.work_id and sp.alias = y.label left join al on al.work_id = y.work_id and al.alias = y.label"""  # noqa: E731
#: Words, each character of a script without blanks one of its own; what stands between two of them in a phrase.
_TOKENS = lambda x: f"""list_filter(string_split_regex(regexp_replace(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}''{UNSPACED} ]+', ' ', 'g'), '([{UNSPACED}])', ' \\1 ', 'g'), ' +'), lambda t: t <> '')"""
_GAP = lambda a, b: f"""case when regexp_full_match({a}, '[{UNSPACED}]') and regexp_full_match({b}, '[{UNSPACED}]') then '' else ' ' end"""
_SQL = lambda text: "'" + text.replace("'", "''") + "'"
_PAGES = f"""with p as (select doc_id, replace({_SQL(PAGE_HEAD.format(title='@'))}, '@', coalesce(source, '')) || '<p>'
        || replace(replace(replace(replace("text", '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10) || chr(10), '</p><p>') || '</p>' || {_SQL(PAGE_TAIL)} h from documents where "text" is not null),
    a as (select doc_id, regexp_replace(regexp_replace(h, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'), '(?i)<(?:p|div|h[1-6])\\b[^<>]*/>', chr(10) || chr(10), 'g') h from p),
    b as (select doc_id, regexp_replace(regexp_replace(h, '(?i)<(?:p|div|br|h[1-6]|li|tr)\\b[^<>]*>', chr(10), 'g'), '(?i)</(?:p|div|h[1-6])\\s*>', chr(10), 'g') h from a),
    c as (select doc_id, replace(replace(replace(replace(regexp_replace(h, '<[^<>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&amp;', '&') h from b),
    d as (select doc_id, regexp_replace(regexp_replace(h, '{LINE_END}', chr(10), 'g'), '{INLINE_SPACE}*\n{INLINE_SPACE}*', chr(10), 'g') h from c)
    select doc_id, {_STRIP("regexp_replace(h, '\\n{4,}', chr(10) || chr(10) || chr(10), 'g')")} "text" from d"""

ORACLE_SQL: dict[str, str] = {
    "transcript_clean": f"with {_EV} select video_id, event_id, {_LINE} line from ev where not coalesce(review_required, false)",
    "transcript_review": f"with {_EV} select video_id, event_id, {_LINE} line from ev",
    "transcript_srt": f"""with {_EV} select video_id, event_id, {_SRT('start_ms')} || ' --> ' || {_SRT('end_ms')} || chr(10)
        || case when coalesce(speaker, '') <> '' then speaker || ': ' else '' end || "text" cue from ev""",
    "transcript_markdown": f"""with {_EV} select video_id, event_id, '- `' || {_STAMP('start_ms')} || '` ' || case when coalesce(speaker, '') <> '' then '**' || speaker || '**: ' else '' end
        || "text" line from ev""",
    "review_cards": f"""with {_EV} select video_id, event_id, '<div class="card" data-event="' || {_ESC('event_id')} || '"><span class="time">' || {_STAMP('start_ms')}
        || '</span><input name="speaker" value="' || {_ESC("coalesce(speaker, '')")} || '"><textarea name="text">' || {_ESC('coalesce("text", chr(0))').replace('chr(0)', "''")} || '</textarea></div>' card
        from ev where review_required""",
    "artifact_columns": f"""with {_EV} select video_id, event_id, case when review_required then 'crops/' || video_id || '/' || event_id || '_dialog.png' end roi_crop_file,
        case when review_required and speaker is not null then 'crops/' || video_id || '/' || event_id || '_name.png' end name_crop_file,
        case when review_required then 'crops/' || video_id || '/' || event_id || '_frame.png' end frame_file from ev""",
    "review_flag": f"""with {_WORK}, x as (select ew.*, w.review_threshold, case when coalesce(speaker, '') <> '' then least(confidence, 0.9::double) else confidence end conf from ew join work_configs w using (work_id))
        select video_id, event_id, conf confidence, (conf < review_threshold) or coalesce(speaker, '') = '' or ({_COUNT('"text"')} < 2 and not (
        regexp_matches({_STRIP('"text"')}, '[。！？）)～~…」』】]$') and {_TIMES('"text"', '（')} = {_TIMES('"text"', '）')} and {_TIMES('"text"', '(')} = {_TIMES('"text"', ')')} and {_COUNT('"text"')} >= 1)) flag from x""",
    "text_quality": f"""with {_EV} select video_id, event_id, cast({_COUNT('"text"')} as int) content, not regexp_matches("text", '{PUNCTUATION_ONLY.replace("'", "''")}') and {_COUNT('"text"')} >= 2
        and {_TIMES('"text"', '（')} = {_TIMES('"text"', '）')} and {_TIMES('"text"', '「')} = {_TIMES('"text"', '」')} passes from ev""",
    "hud_filter": f"""with {_EV} select video_id, event_id, "text" from ev where {_HUD(_STRIP('"text"'))}""",
    "punct_normalize": f"""with {_EV} select video_id, event_id, {_STRIP(_ASCII('"text"'))} norm from ev""",
    "ocr_fusion": """with x as (select video_id, event_id, ocr_candidates[1] p, ocr_candidates[2] f from dialogue_events),
        y as (select *, f is not null and p.confidence < 0.7 tried from x),
        z as (select *, tried and f.confidence > p.confidence surer, tried and f.confidence = p.confidence and length(f."text") > length(p."text") longer from y)
        select video_id, event_id, case when p is null then null when surer or longer then f.engine else p.engine end chosen_engine,
        case when p is null then null when surer or longer then f."text" else p."text" end chosen_text,
        case when p is null then null when surer or longer then f.confidence else p.confidence end chosen_confidence,
        case when p is null then null when surer then printf('fallback:%s(conf %.3f>%.3f)', f.engine, f.confidence, p.confidence) when longer then printf('fallback:%s(longer text)', f.engine)
             when tried then printf('primary:%s(fallback tried, primary kept)', p.engine) else printf('primary:%s', p.engine) end chosen_reason,
        case when p is null then 0 when tried then 2 else 1 end n_candidates from z""",
    "ocr_fusion_tables": """with c as (select video_id, event_id, max(ocr_candidates[1]) p, max(ocr_candidates[2]) f from dialogue_events group by all having max(ocr_candidates[1]) is not null),
        y as (select *, f is not null and p.confidence < 0.7 tried from c),
        z as (select *, tried and f.confidence > p.confidence surer, tried and f.confidence = p.confidence and length(f."text") > length(p."text") longer from y)
        select video_id, event_id, case when surer or longer then f.engine else p.engine end engine, case when surer or longer then f."text" else p."text" end "text",
        case when surer or longer then f.confidence else p.confidence end confidence,
        case when surer then printf('fallback:%s(conf %.3f>%.3f)', f.engine, f.confidence, p.confidence) when longer then printf('fallback:%s(longer text)', f.engine)
             when tried then printf('primary:%s(fallback tried, primary kept)', p.engine) else printf('primary:%s', p.engine) end reason from z""",
    "engine_line_combine": """with x as (select distinct video_id, event_id, i, ocr_candidates[i]."text" t, ocr_candidates[i].confidence c from (select *, unnest(range(1, len(ocr_candidates) + 1)) i from dialogue_events))
        select video_id, event_id, string_agg(coalesce(t, ''), ' ' order by i, coalesce(t, '')) "text", round(avg(c), 6) confidence from x group by all""",
    "speaker_normalize": f"""with {_WORK}, {_NAMES}
        select video_id, event_id, speaker, coalesce(special, canonical, speaker) speaker_norm from ew left join sp on sp.work_id = ew.work_id and sp.alias = ew.speaker
        left join al on al.work_id = ew.work_id and al.alias = ew.speaker""",
    "known_speakers": f"with {_NAMES} select work_id, n speaker from known",
    "speaker_inherit": f"""with {_EV}, g as (select *, last_value(case when trim(speaker) <> '' and confidence >= 0.8 then {{'s': speaker, 'c': confidence}} end ignore nulls)
            over (partition by video_id order by start_ms, event_id rows between unbounded preceding and current row) v from ev)
        select video_id, event_id, v.s inherited_speaker, coalesce(v.c, 0.0::double) inherited_confidence from g""",
    "speaker_from_text": f"""with {_EV}, {_NAMES}, paths as (select video_id, event_id, speaker, "text", confidence from ev union all
            select video_id, event_id, max(speaker), max("text"), max(confidence) from spoken_events group by all), x as (select paths.*, r.work_id from paths join video_runs r using (video_id))
        select video_id, event_id, case when hit then meant else speaker end speaker, case when hit then rest else "text" end "text", confidence, case when hit then confidence end speaker_confidence
        from ({_LABELLED('x')})""",
    "event_attribution": f"""with {_NUM}, {_NAMES}, p as (select num.*, {_STRIP('"text"')} t, {_STRIP("""left("text", cast(floor(length("text") * 8 / 10) as int))""")} typed from num),
        q as (select *, case when length(typed) >= 2 then 0 else 1 end i0, case when length(typed) >= 2 then 8 else 4 end i1, row_number() over (partition by video_id order by "number") k,
              {_STRIP('speaker')} name from p where length(t) >= 2),
        g as (select *, case when name <> '' and ("number" % 3 = 2 or "number" % 3 = 0 and i0 = 1) then name end g0, case when name <> '' and "number" % 3 <> 1 then name end g1 from q),
        h as (select *, count(g1) over (partition by video_id order by k) m from g),
        u as (select *, case when g1 is not null and m = 1 then g1 when m > 0 then g0 end read from h),
        v as (select *, last_value(read ignore nulls) over (partition by video_id order by k rows between unbounded preceding and current row) raw from u),
        w as (select v.video_id, printf('event_%06d', k) event_id, cast(("number" * 6.0 + i0 * 0.5) * 1000 as bigint) start_ms, cast(("number" * 6.0 + i1 * 0.5) * 1000 as bigint) end_ms,
              v.raw, t "text", round(confidence, 6) confidence, printf('frame %d', i1 - 1) shown_on, r.work_id from v join video_runs r using (video_id)),
        x as (select w.*, coalesce(sp.special, al.canonical, raw) speaker from w left join sp on sp.work_id = w.work_id and sp.alias = raw left join al on al.work_id = w.work_id and al.alias = raw)
        select video_id, event_id, start_ms, end_ms, case when hit then meant else speaker end speaker, case when hit then rest else "text" end "text", confidence,
        case when hit then confidence when speaker is not null then 0.9::double else 0.0::double end speaker_confidence, shown_on from ({_LABELLED('x')})""",
    "profile_steps": """with w as (select distinct work_id, unnest([dialog_preprocess, name_preprocess]) name from work_configs),
        s as (select * from (values ('default', 0, 'upscale'), ('semi_transparent', 0, 'upscale'), ('semi_transparent', 1, 'contrast'), ('semi_transparent', 2, 'sharpen'), ('semi_transparent', 3, 'binarize'),
            ('outline_heavy', 0, 'upscale'), ('outline_heavy', 1, 'contrast'), ('outline_heavy', 2, 'sharpen'), ('small_font', 0, 'upscale'), ('small_font', 1, 'sharpen'), ('small_font', 2, 'denoise'),
            ('dark_bg', 0, 'upscale'), ('dark_bg', 1, 'contrast'), ('dark_bg', 2, 'binarize'), ('dark_bg', 3, 'invert')) t(name, "position", step))
        select work_id, name, "position", step from w left join s using (name)""",
    "prefix_merge": f"""with {_FRAGMENTS}, a as (select *, lead(start_ms) over w ns, lead(speaker) over w nsp, lead("text") over w nt, lead(event_id) over w ne, lag(event_id) over w pe,
            row_number() over w rn, count(*) over (partition by video_id) n from fr window w as (partition by video_id order by start_ms, event_id)),
        b as (select *, coalesce(ne is not null and ns - end_ms < 5000 and speaker is not distinct from nsp and length("text") >= 2 and length("text") < length(nt)
            and starts_with({_ASCII('nt')}, {_ASCII('"text"')}), false) flag from a),
        c as (select *, max(case when flag then 0 else rn end) over (partition by video_id order by rn rows unbounded preceding) off from b),
        d as (select *, flag and (rn - off) % 2 = 1 goes from c),
        e as (select *, lag(goes) over w came, lag(start_ms) over w ps from d window w as (partition by video_id order by rn))
        select video_id, event_id, case when came then ps else start_ms end start_ms, end_ms, "text", case when came then pe end merged_from from e
        where not goes and not (coalesce({_HUD(_STRIP('"text"'))}, false) and n > 1)""",
    "candidate_merge": f"""with {_FRAMES}, p as (select video_id, "number", "text", count(*) n_seen, sum(confidence) total, min(ts) f from seen where "text" <> '' group by all)
        select video_id, "number", "text", round(total / n_seen, 6) confidence, n_seen from p
        qualify row_number() over (partition by video_id, "number" order by length("text") desc, n_seen desc, round(total, 9) desc, f) = 1""",
    "longest_so_far": f"""with {_FRAMES}, x as (select *, max(length("text")) over (partition by video_id order by ts, "text" rows unbounded preceding) n from seen)
        select video_id, ts, "text", arg_max("text", {{'n': length("text"), 't': -ts}}) over (partition by video_id order by ts, "text" rows unbounded preceding) longest from x""",
    "frame_sample_asof": f"""with {_FIRST}, g as (select video_id, unnest(generate_series(0, cast(max(ts) // 5 as bigint) + 1)) * 5.0::double grid_ts from f group by video_id)
        select g.video_id, g.grid_ts, f.ts frame_ts, f.event_id from (select *, grid_ts - 0.1::double low from g) g asof join f on f.video_id = g.video_id and g.low <= f.ts""",
    "frame_at": f"""with {_FIRST}, q as (select distinct video_id, unnest([30.0::double, 120.0::double, 600.0::double]) "at" from video_runs)
        select q.video_id, q."at", f.ts frame_ts, f.event_id from q asof left join f on f.video_id = q.video_id and q."at" <= f.ts""",
    "change_detect": f"""with {_SIG}, x as (select *, lag("value") over (partition by "key" order by ts, event_id) p, row_number() over (partition by "key" order by ts, event_id) rn from sig)
        select "key", event_id, round(case when rn = 1 then 1.0::double else abs("value" - p) / 255.0::double end, 9) diff_ratio, case when rn = 1 then true else abs("value" - p) / 255.0::double > 0.05::double end changed from x""",
    "progress_ticks": f"""with {_EV} select video_id, cast(floor(start_ms / 1000 / 30.0::double) as bigint) tick, count(*) n from ev group by all""",
    "speaker_runs": f"""with {_EV}, x as (select video_id, coalesce(speaker, '') speaker, start_ms, row_number() over (partition by video_id order by start_ms, event_id)
            - row_number() over (partition by video_id, coalesce(speaker, '') order by start_ms, event_id) g from ev)
        select video_id, speaker, min(start_ms) "first", max(start_ms) "last", count(*) n from x group by video_id, speaker, g""",
    "arrival_windows": """select time_bucket(interval 10 minutes, ingested_at) window_start, split_part(source_file, '/', 1) source, count(*) n_events, count(*) filter (review_required) n_review
        from dialogue_events where ingested_at is not null group by all""",
    "corrections_apply": f"""with {_EV}, c as (select * from corrections qualify row_number() over (partition by video_id, event_id order by submitted_at desc nulls last, reviewer desc nulls last, "text" desc nulls last,
            speaker desc nulls last, accepted desc nulls last) = 1)
        select ev.video_id, ev.event_id, coalesce(c.speaker, ev.speaker) speaker, coalesce(c."text", ev."text") "text", case when coalesce(c.accepted, false) then false else ev.review_required end review_required,
        c.event_id is not null corrected from ev left join c on c.video_id = ev.video_id and c.event_id = ev.event_id""",
    "pending_outputs": "select video_id, status from video_runs r where kind = 'ocr' and not exists (select 1 from dialogue_events d where d.video_id = r.video_id)",
    "run_summary": f"with {_EV} select video_id, count(*) total_events, count(*) filter (review_required) review_count, round(max(end_ms) / 1000, 3) duration_processed from ev group by all",
    "batch_summary": """select work_id, count(*) total_videos, count(*) filter (status = 'ok') succeeded, count(*) filter (status = 'error') failed, cast(sum(total_events) as bigint) total_events from video_runs group by all""",
    "batch_records": """select video_id, status, total_events, review_count, null::varchar error from video_runs where status = 'ok' union all
        select video_id, status, null, null, error from video_runs where status = 'error'""",
    "jsonl_tail": f"with {_NUM} select video_id, arg_max(event_id, \"number\") last_event_id, count(*) event_count from num group by all",
    "resume_cut": f"""with {_EV} select ev.video_id, ev.event_id from ev left join (select video_id, floor(duration_processed * 500) done from video_runs where duration_processed is not null) r using (video_id)
        where done is null or start_ms > done""",
    "resume_points": f"""with {_EV} select r.video_id, cast(floor(duration_processed * 1000) as bigint) last_processed_ms, count(ev.event_id) event_count from video_runs r left join ev using (video_id)
        where duration_processed is not null group by all""",
    "spine_order": """with d as (select * from documents where work_id is not null)
        select s.work_id book, s.doc_id place, m.source || '/' || m.doc_id href from d s join d m on m.work_id = s.work_id and m.doc_id = s.doc_id and m.lang is not null where s.source = 'novel_chapter'""",
    "chapter_concat": """with x as (select work_id, string_agg("text", chr(10) || chr(10) || '---' || chr(10) || chr(10) order by doc_id, "text") t from documents
            where source = 'novel_chapter' and work_id is not null and "text" is not null group by all)
        select work_id, length(t) n_chars, md5(t) digest from x""",
    "html_to_text": _PAGES,
    "html_to_text_sql": _PAGES,
    "roi_box": """select work_id, cast(trunc(dialog_box.x * 1920) as int) "left", cast(trunc(dialog_box.y * 1080) as int) top, cast(trunc((dialog_box.x + dialog_box.w) * 1920) as int) "right",
        cast(trunc((dialog_box.y + dialog_box.h) * 1080) as int) bottom from work_configs""",
    "roi_validate": "select work_id, " + ", ".join(f"""case when {b} is null or {b}.x is null or {b}.y is null or {b}.w is null or {b}.h is null then 'missing'
        when not ({b}.x between 0 and 1 and {b}.y between 0 and 1 and {b}.w between 0 and 1 and {b}.h between 0 and 1) then 'range' when {b}.w <= 0 or {b}.h <= 0 then 'area'
        when {b}.x + {b}.w > 1 or {b}.y + {b}.h > 1 then 'overflow' end {n}""" for b, n in (("dialog_box", "dialog_error"), ("name_box", "name_error"))) + " from work_configs",
    "roi_validate_pixel": f"""with b as (select work_id, {_PIXEL('dialog_box')} from work_configs)
        select work_id, concat_ws(',', case when x < 0 then 'x' end, case when y < 0 then 'y' end, case when width <= 0 then 'width' end, case when height <= 0 then 'height' end,
        case when x + width > 1280 then 'right' end, case when y + height > 720 then 'bottom' end) errors from b""",
    "roi_rescale": f"""with b as (select work_id, {_PIXEL('name_box')} from work_configs)
        select work_id, cast(trunc(x * (1920 / 1280)) as int) x, cast(trunc(y * (1080 / 720)) as int) y, cast(trunc(width * (1920 / 1280)) as int) width, cast(trunc(height * (1080 / 720)) as int) height from b""",
    "roi_frame_check": """with b as (select work_id, trunc(name_box.x * 640) l, trunc(name_box.y * 360) t, trunc((name_box.x + name_box.w) * 640) r, trunc((name_box.y + name_box.h) * 360) m from work_configs)
        select work_id, l >= 0 and t >= 0 and r <= 640 and m <= 360 and r - l >= 50 and m - t >= 20 fits from b""",
    "profile_override": """select * from (values ('default', 1.5::double, false, false, false, 128, 1.0::double, false), ('semi_transparent', 2.0, true, false, true, 100, 1.8, false),
            ('outline_heavy', 2.0, true, false, false, 128, 1.5, false), ('small_font', 3.0, true, true, false, 128, 1.0, false), ('dark_bg', 4.0, false, false, false, 128, 1.0, false))
            t(name, upscale_factor, sharpen, denoise, binarize, binarize_threshold, contrast_enhance, invert)
        union all select 'own_' || dialog_preprocess, max(target_fps), false, false, false, 128, 1.0, false from work_configs group by dialog_preprocess""",
    "tag_rules": """select work_id, tag, rule from (select work_id, unnest([dialog_preprocess, ocr_engine]) tag from work_configs)
        left join (values ('easyocr', 'slow'), ('paddleocr', 'fast'), ('outline_heavy', 'sharpen first')) r(tag, rule) using (tag)""",
    "catchphrase_ngrams": f"""with {_EV}, w as (select speaker, {_TOKENS('lower("text")')} w from ev where speaker is not null),
        g as (select speaker, unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || {_GAP('w[k]', 'w[k + 1]')} || w[k + 1] || {_GAP('w[k + 1]', 'w[k + 2]')} || w[k + 2])) phrase from w where len(w) >= 3)
        select speaker, phrase, count(*) n from g group by all having count(*) >= 3""",
    "particle_counts": f"""with {_EV} select speaker, token, count(*) n from (select speaker, unnest(regexp_extract_all("text", '嗯|呐|呢|吗|哦|啊|嘛|呀|吧|ね|よ|わ')) token from ev where speaker is not null) group by all""",
    "address_forms": f"""with {_WORK}, w as (select work_id, speaker, {_TOKENS('"text"')} w from ew where speaker is not null),
        n as (select distinct work_id, name, {_TOKENS('name')} p from (select work_id, unnest(map_keys(speaker_aliases)) name from work_configs)),
        c as (select speaker, name, len(list_filter(range(1, len(w) - len(p) + 2), lambda k: w[k:k + len(p) - 1] = p)) c from w join n using (work_id) where len(p) > 0)
        select speaker, name, cast(sum(c) as bigint) n from c where c > 0 group by all""",
    "info_routing": f"""with {_NUM}, k as (select video_id, event_id, ['world', 'style', 'both', 'plot', 'unknown']["number" % 5 + 1] kind from num)
        select video_id, event_id, kind, target from k join (values ('world', 'story'), ('ability', 'story'), ('plot', 'story'), ('relationship', 'story'), ('knowledge', 'story'), ('style', 'persona'),
        ('expression', 'persona'), ('emotion', 'persona'), ('behaviour', 'persona'), ('personality', 'persona'), ('both', 'story'), ('both', 'persona')) r(kind, target) using (kind)""",
    "correction_triggers": f"""select video_id, event_id, submitted_at, regexp_matches("text", '{"|".join((*OBJECTIONS, "never", "nunca", "从没", "ない"))}') objects from corrections""",
    "fact_classify": f"""with {_EV}, o as (select video_id, event_id, speaker old, true a from ev), n as (select video_id, event_id, max(speaker) new, true b from corrections group by all)
        select video_id, event_id, case when a is null then 'new' when b is null then 'kept' when old is null and new is not null then 'fixed' when old is not distinct from new then 'same'
        when starts_with(new, old) then 'extended' else 'conflict' end status from o full join n using (video_id, event_id)""",
    "name_slug": "select work_id, regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') slug from work_configs",
    "seconds_to_ms": f"""with x as (select video_id, cast(trunc(duration_processed * 1000) as bigint) ms from video_runs)
        select video_id, ms, case when ms is not null then {_STAMP('ms')} else '[null:null:null]' end stamp from x""",
    "event_numbering": f"""with {_EV} select video_id, printf('event_%06d', row_number() over (partition by video_id order by start_ms, end_ms, "text")) event_id, "text", confidence from ev""",
    "eval_interval_match": f"with {_GOLD} select video_id, gold_id, event_id, case when event_id is not null then overlap_ms end overlap_ms from m where rn = 1",
    "eval_recall": f"with {_GOLD} select count(*) n_gold, count(event_id) n_recalled, round(count(event_id) / count(*), 6) recall from m where rn = 1",
    # levenshtein counts bytes: the characters of each pair of texts are written as bytes first
    "eval_cer": f"""with {_GOLD}, c as (select *, list_distinct(string_split(coalesce("text", '') || gold_text, '')) chars from m where rn = 1 and event_id is not null and gold_text <> ''),
        d as (select *, array_to_string(chars, '') seen, array_to_string(list_transform(range(1, len(chars) + 1), lambda k: chr(cast(k as int))), '') bytes from c)
        select video_id, count(*) n_matched, round(avg(levenshtein(translate(coalesce("text", ''), seen, bytes), translate(gold_text, seen, bytes)) / length(gold_text)), 6) mean_cer from d group by all""",
    "eval_duplicate_rate": f"""with {_EV}, x as (select {_STRIP(_ASCII('"text"'))} t, lag({_STRIP(_ASCII('"text"'))}) over (partition by video_id, coalesce(speaker, '') order by start_ms, event_id) p from ev)
        select count(*) n_events, count(*) filter (t = p) n_duplicates, round(count(*) filter (t = p) / count(*), 6) duplicate_rate from x""",
    "eval_review_rate": f"with {_EV} select video_id, count(*) n_events, count(*) filter (review_required) n_review, round(count(*) filter (review_required) / count(*), 6) review_rate from ev group by all",
    "eval_speaker_accuracy": f"""with {_EV}, c as (select video_id, event_id, arg_max(speaker, submitted_at) meant from corrections where accepted and speaker is not null group by all)
        select count(*) n_checked, count(*) filter (coalesce(speaker, '') = meant) n_right, round(count(*) filter (coalesce(speaker, '') = meant) / count(*), 6) accuracy from ev join c using (video_id, event_id)""",
    "event_files": f"""with {_EV} select video_id, event_id, start_ms, end_ms, speaker, "text", confidence, review_required, source_file from ev where speaker is not null or review_required""",
    "event_file_tail": f"""with {_NUM} select arg_max(event_id, "number") last_event_id, count(*) event_count from num where video_id = (select max(video_id) from video_runs where status = 'running')""",
    "correction_files": """select video_id, event_id, speaker, "text", accepted from corrections qualify row_number() over (partition by video_id, event_id order by submitted_at desc nulls last, reviewer desc nulls last,
        "text" desc nulls last, speaker desc nulls last, accepted desc nulls last) = 1""",
    "config_files": "select work_id, name, target_fps, review_threshold, ocr_engine, null::varchar error from work_configs",
    "recognised_files": f"""with s as (select video_id, event_id, min(start_ms) ms, max("text") t from spoken_events group by all having min(start_ms) is not null and max("text") is not null)
        select video_id, count(*) n_lines, min({_STAMP('ms')}) first_stamp from s group by all""",
    "review_pages": f"""with {_NUM}, c as (select video_id, "number" // 50 page, event_id, '<div class="card" data-event="' || {_ESC('event_id')} || '"><span class="time">' || {_STAMP('start_ms')}
            || '</span><input name="speaker" value="' || {_ESC("coalesce(speaker, '')")} || '"><textarea name="text">' || {_ESC('"text"')} || '</textarea></div>' card from num where review_required)
        select video_id, page, md5({_SQL(PAGE_TOP)} || string_agg(card, '' order by event_id) || {_SQL(PAGE_END)}) digest from c group by all""",
    "book_chapters": f"""with d as (select *, row_number() over (partition by work_id order by doc_id) k from documents where source = 'novel_chapter' and work_id is not null)
        select work_id path, cast(2 * (k - 1) as int) place, doc_id || '.xhtml' href, null::varchar error from d where {_STRIP("coalesce(\"text\", '')")} <> ''""",
}
