"""On-screen text: page index, frame selection, item gate and classes, comments read out, inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.operators import intervals as iv

#: Default rules.
PAGES = {"stability_min": 60, "region_diff_change": 40, "text_value_min": 30, "minimum_transition_run": 3}
CLASSES = {
    "minimum_confidence": 0.55,
    "excluded_markers": {
        "danmaku": ["弹幕"],
        "high_speed_chat": ["聊天室", "刷屏"],
        "follow_gift_prompt": ["关注", "点赞", "投币", "礼物", "打赏", "一键三连", "充电"],
        "logo": ["台标", "logo", "LOGO"],
        "watermark": ["水印"],
        "platform_shell": ["正在直播", "直播中", "推荐视频", "首页"],
    },
    "category_markers": {
        "background_ui": ["下一页", "上一页", "设置", "菜单", "返回", "播放", "暂停", "音量"],
        "speaker_supplement": ["补充", "旁白", "注：", "备注"],
    },
}
HOST_READ = {"minimum_comment_length": 3, "match_window_seconds": 2, "selection_markers": ["这条", "这个问题", "这条评论", "有人问", "有观众问", "有网友问", "评论区", "弹幕问"]}
#: What comparison leaves out, white space and punctuation.
STRIPPED = " \t\r\n　，。！？：；、,.!?:;\"'“”‘’「」『』（）()【】[]…—~"
#: Why a frame was selected or not.
SELECTED, TRANSITION, BELOW, DUPLICATE = "selected_page_representative", "unselected_transition_frame", "unselected_below_text_value", "unselected_duplicate_of_selected"


def plain(text: Column | str) -> Column:
    """A text without white space and punctuation, for comparison."""
    return F.translate(text, STRIPPED, "")


def settled(frames: DataFrame, rules: dict | None = None) -> DataFrame:
    """Adds settled: neither a change of the region nor an unstable frame."""
    r = PAGES if rules is None else rules
    return frames.withColumn("settled", ~((F.col("region_diff") >= r["region_diff_change"]) | (F.col("stability") < r["stability_min"])))


def page_index(frames: DataFrame) -> DataFrame:
    """Appearances of pages from settled(frames): runs of settled frames of one fingerprint, pages numbered by first appearance."""
    runs = iv.runs(frames, ["part_id"], ["place"], F.struct("settled", "fingerprint")).where("settled")
    seen = runs.groupBy("part_id", "run", "fingerprint").agg(F.min("pts").alias("first_pts"), F.max("pts").alias("last_pts"), F.count("*").alias("n"), F.min("place").alias("at"))
    seen = seen.withColumn("first_at", F.min("at").over(Window.partitionBy("part_id", "fingerprint")))
    return seen.withColumn("page", F.dense_rank().over(Window.partitionBy("part_id").orderBy("first_at")))


def frame_selection(frames: DataFrame, rules: dict | None = None) -> DataFrame:
    """Every frame of settled(frames) with its page and the reason why it is or is not its page's representative.

    The representative is the earliest settled frame of a page with enough text.
    """
    r = PAGES if rules is None else rules
    pages = page_index(frames).select("part_id", "fingerprint", "page").distinct()
    rows = frames.join(pages, ["part_id", "fingerprint"], "left").withColumn("page", F.when(F.col("settled"), F.col("page")))
    legible = F.col("settled") & (F.col("edge_density") >= r["text_value_min"])
    first = F.min(F.when(legible, F.col("place"))).over(Window.partitionBy("part_id", "page"))
    reason = F.when(~F.col("settled"), TRANSITION).when(legible & (F.col("place") == first), SELECTED).when(~legible, BELOW).otherwise(DUPLICATE)
    return rows.withColumn("reason", reason)


def transition_runs(frames: DataFrame, rules: dict | None = None) -> DataFrame:
    """(part_id, start_t, end_t, n): maximal runs of frames of settled(frames) without a page, long enough."""
    r = PAGES if rules is None else rules
    runs = iv.runs(frames, ["part_id"], ["place"], F.col("settled")).where("not settled")
    return runs.groupBy("part_id", "run").agg(F.min("pts").alias("start_t"), F.max("pts").alias("end_t"), F.count("*").alias("n")).where(F.col("n") >= r["minimum_transition_run"]).drop("run")


def item_gate(items: DataFrame, parts: DataFrame, pages: DataFrame, item: str) -> DataFrame:
    """items (part_id, item, pts, page) with outcome: visual_text_part_unknown, ocr_item_out_of_coverage (not in [start, end)),
    ocr_item_unknown_page, ocr_item_page_time_mismatch (in no appearance, ends included), else admitted.

    parts: part_id, start_t, end_t; pages: part_id, page, first_pts, last_pts, a row for each appearance.
    """
    shown = items.join(pages.select("part_id", "page", "first_pts", "last_pts"), ["part_id", "page"], "left").groupBy("part_id", item, "pts", "page").agg(F.bool_or(F.col("pts").between(F.col("first_pts"), F.col("last_pts"))).alias("shown"))
    rows = shown.join(parts.select("part_id", "start_t", "end_t"), "part_id", "left")
    outcome = (F.when(F.col("start_t").isNull(), "visual_text_part_unknown").when((F.col("pts") < F.col("start_t")) | (F.col("pts") >= F.col("end_t")), "ocr_item_out_of_coverage")
               .when(F.col("shown").isNull(), "ocr_item_unknown_page").when(~F.col("shown"), "ocr_item_page_time_mismatch").otherwise("admitted"))
    return rows.select("part_id", item, "pts", "page", outcome.alias("outcome"))


def classified(items: DataFrame, rules: dict | None = None) -> DataFrame:
    """Adds class, kind and marker to items (text, confidence).

    By precedence: the first marker of the noise kinds in order (class excluded, with kind and marker), a confidence
    below the floor (classification_uncertain), the categories' markers in order, else page_text.
    """
    r = CLASSES if rules is None else rules
    t = F.col("text")
    hit = F.when(F.lit(False), F.struct(F.lit("").alias("kind"), F.lit("").alias("marker")))
    for kind, markers in r["excluded_markers"].items():
        for m in markers:
            hit = hit.when(t.contains(m), F.struct(F.lit(kind).alias("kind"), F.lit(m).alias("marker")))
    rest = F.when(F.coalesce(F.col("confidence") < r["minimum_confidence"], F.lit(True)), "classification_uncertain")
    for category, markers in r["category_markers"].items():
        for m in markers:
            rest = rest.when(t.contains(m), category)
    rows = items.withColumn("_hit", hit)
    return rows.withColumn("class", F.when(F.col("_hit").isNotNull(), "excluded").otherwise(rest.otherwise("page_text"))).withColumn("kind", F.col("_hit.kind")).withColumn("marker", F.col("_hit.marker")).drop("_hit")


def host_reads(comments: DataFrame, cues: DataFrame, key: str, comment: str, cue: str, width: int, per_second: int, rules: dict | None = None) -> DataFrame:
    """(key, comment, cited, basis) of comments (key, comment, pts, text) that a cue within the window reads out, both ends included.

    cited are the cues in order of start and id. basis is host_selected if a marker stands in one of them beside the
    comment's first place, else host_read.
    """
    r = HOST_READ if rules is None else rules
    window = r["match_window_seconds"] * per_second
    asked = comments.select(key, comment, (F.col("pts") - window).alias("start_t"), (F.col("pts") + window).alias("end_t"), plain("text").alias("phrase")).where(F.length("phrase") >= r["minimum_comment_length"])
    said = cues.select(key, cue, "start_t", "end_t", plain("text").alias("plain"))
    near = iv.overlap_join(asked, said, [key], width, closed=True).where(F.contains("plain", "phrase"))
    framing = F.expr("concat(substring(plain, 1, instr(plain, phrase) - 1), substring(plain, instr(plain, phrase) + length(phrase)))")
    marked = F.lit(False)
    for m in r["selection_markers"]:
        marked = marked | framing.contains("".join(c for c in m if c not in STRIPPED))
    g = near.groupBy(key, comment).agg(F.sort_array(F.collect_list(F.struct(F.col("r_start").alias("t"), F.col(cue).alias("id")))).alias("c"), F.bool_or(marked).alias("marked"))
    return g.select(key, comment, F.transform("c", lambda x: x["id"]).alias("cited"), F.when(F.col("marked"), "host_selected").otherwise("host_read").alias("basis"))


def inventory(key: str, **lists: DataFrame) -> DataFrame:
    """(key, one array a name): every part that any of the tables (key, item) names, each with its sorted items."""
    rows = None
    for name, df in lists.items():
        own = df.select(key, *[(F.col("item") if n == name else F.lit(None).cast(df.schema["item"].dataType)).alias(n) for n in lists])
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy(key).agg(*[F.sort_array(F.collect_list(n)).alias(n) for n in lists])


def embedded_media(runs: DataFrame, audio: DataFrame, reports: DataFrame, key: str, width: int, active: str = "speech_likely") -> DataFrame:
    """runs (key, start_t, end_t, ...) of frames without a page, with basis and overlapping_audio, array<struct<start_t,end_t>> in order.

    audio: key, start_t, end_t, state, of which active ones count that touch the run, both ends included; reports names
    the keys for which there is an audio report. Without one the basis is picture_only and nothing overlaps; an empty
    report makes it picture_plus_audio, too.
    """
    told = reports.select(key).distinct().withColumn("_told", F.lit(True))
    sound = audio.where(F.col("state") == active).select(key, "start_t", "end_t").join(told.select(key), key, "left_semi").withColumn("_sound", F.lit(True))
    pairs = iv.overlap_join(runs, sound, [key], width, "left", closed=True)
    near = F.array_sort(F.collect_list(F.when(F.col("_sound"), F.struct(F.col("r_start").alias("start_t"), F.col("r_end").alias("end_t")))))
    found = pairs.groupBy(*runs.columns).agg(near.alias("overlapping_audio"))
    return found.join(told, key, "left").withColumn("basis", F.when(F.col("_told"), "picture_plus_audio").otherwise("picture_only")).drop("_told")


def resource_plan(representatives: DataFrame, key: str, seconds: int, size: int, most: int) -> DataFrame:
    """(key, selected, seconds, bytes, fits) of page_representatives: what reading each key's selected frames takes, and whether they are at most `most`."""
    n = representatives.where(F.col("reason") == SELECTED).groupBy(key).agg(F.count(F.lit(1)).alias("selected"))
    return n.select(key, "selected", (F.col("selected") * seconds).alias("seconds"), (F.col("selected") * size).alias("bytes"), (F.col("selected") <= most).alias("fits"))
