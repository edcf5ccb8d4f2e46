"""Registered preparation, sampling, label and scoring queries over the driver's tables, with
their SQL oracles (DuckDB dialect)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asrprep.functions import text as T
from asrprep.functions.urls import SIGNED_PATH_PREFIX, URL_PATH_RE, file_name, object_path, prefix_missing
from asrprep.operators import features, labels, ledger, manifest, preparation, sampling, scoring
from asrprep.operators.enrich import HashSigner, enrich
from asrprep.plans.stand_ins import table
from asrprep.session import scratch_path
from asrprep.streaming import prepare as stream

SEED = 42
SPLITS = "en+fr+de+es"
BACKLOG_SIZE = 500
COLLATE_BATCH = 8

# ---- SQL building blocks (same constants as the Spark side) ---------------------------------
_WS_CLASS = f"[{T.WS_CLASS_BODY}]"
_WS_LIT = "'" + T.WHITESPACE_CHARS + "'"
_WORD = T.WORD


def _sql_strip(x: str) -> str:
    return f"trim({x}, {_WS_LIT})"


def _sql_scoring_words(x: str) -> str:
    collapsed = f"regexp_replace({x}, {_q(_WS_CLASS + _WS_CLASS + '+')}, ' ', 'g')"
    return f"list_filter(string_split({_sql_strip(collapsed)}, ' '), lambda w: length(w) > 0)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_normalize(x: str) -> str:
    t = f"lower({x})"
    t = f"regexp_replace({t}, {_q(r'[<\[][^>\]]*[>\]]')}, '', 'g')"
    t = f"regexp_replace({t}, {_q(r'\(([^)]+?)\)')}, '', 'g')"
    t = f"regexp_replace({t}, {_q(r'[\p{M}\p{S}\p{P}]')}, ' ', 'g')"
    t = f"lower({t})"
    return f"regexp_replace({t}, {_q(_WS_CLASS + '+')}, ' ', 'g')"


def list_edit_distance_sql(r: str, h: str) -> str:
    return (f"list_last(list_reduce({r}, lambda prev, x: list_reduce(range(1, len({h}) + 1), "
            f"lambda cur, j: list_append(cur, least(prev[j + 1] + 1, cur[j] + 1, prev[j] + if({h}[j] = x, 0, 1))), "
            f"[prev[1] + 1]), range(0, len({h}) + 1)))")


# ---- scoring ---------------------------------------------------------------------------------

def _eval_pairs(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    a = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("ref"))
    b = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hyp"))
    return a.join(b, ["conv_id", "turn"], "inner")


def word_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_pairs(_eval_pairs(spark, sf_dir)).select("conv_id", "turn", "edits", "ref_words", "hyp_words")


def corpus_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.corpus_wer(scoring.score_pairs(_eval_pairs(spark, sf_dir)))


def corpus_wer_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.corpus_wer(scoring.score_pairs(_eval_pairs(spark, sf_dir), normalize=True))


_PAIRS_SQL = """pairs AS (SELECT a.conv_id, a.turn, a.text AS ref, b.text AS hyp
           FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
           WHERE a.role = 'user')"""


def _scored_sql(normalize: bool) -> str:
    if normalize:
        src = (f"SELECT conv_id, turn, {_sql_normalize('ref')} AS ref, {_sql_normalize('hyp')} AS hyp FROM pairs")
        src = f"SELECT * FROM ({src}) WHERE length({_sql_strip('ref')}) > 0"
    else:
        src = "SELECT * FROM pairs"
    return f"""{_PAIRS_SQL},
src AS ({src}),
sw AS (SELECT conv_id, turn, {_sql_scoring_words('ref')} AS rw, {_sql_scoring_words('hyp')} AS hw FROM src),
scored AS (SELECT conv_id, turn, ({list_edit_distance_sql('rw', 'hw')})::BIGINT AS edits,
                  len(rw)::BIGINT AS ref_words, len(hw)::BIGINT AS hyp_words FROM sw)"""


_WER_SELECT = """SELECT round(100.0 * sum(edits) / sum(ref_words), 6)::DOUBLE AS wer, sum(edits)::BIGINT AS edits,
       sum(ref_words)::BIGINT AS ref_words, count(*)::BIGINT AS pairs FROM scored"""

# ---- text ------------------------------------------------------------------------------------


def clean_transcription(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.clean_transcription("text").alias("text_stripped"),
                    T.clean_transcription("text", lower_case=True, remove_punct=True).alias("text_clean"))


def normalize_for_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.normalize_for_scoring("text").alias("normalized"))


# ---- manifest --------------------------------------------------------------------------------

# beginnings of objects: none, empty, WAV, FLAC, Ogg, MP3 with and without a tag, none of these
AUDIO_HEADS = (None, "", "524946460000000057415645", "664C614300", "4F67675300", "49443304", "FFFB9064", "3C68746D6C3E", "5249464600000000")


def _reasons(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "html")
    j = d.join(p, "doc_id", "left")
    audio = F.col("html").cast("binary")
    # stand-in decodability: the stored object is a complete document of its declared type
    decodable = F.col("html").startswith("<!DOCTYPE html>")
    return j.withColumn("reject_reason", manifest.reject_reason(audio, F.col("text"), decodable))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(spark, sf_dir).select("doc_id", "reject_reason")


def reject_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validity check with its own look at the audio's container, all outcomes."""
    heads = F.array(*[F.lit(h) for h in AUDIO_HEADS])
    k, t = (F.col("doc_id") % len(AUDIO_HEADS)).cast("int"), F.col("doc_id") % 5
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.unhex(F.get(heads, k)).alias("audio"),
        F.when(t == 1, F.lit(" \t\n")).when(t != 0, F.col("text")).alias("text"))
    return rows.select("doc_id", manifest.audio_format("audio").alias("format"),
                       manifest.reject_reason(F.col("audio"), F.col("text")).alias("reject_reason"))


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.run_counters(_reasons(spark, sf_dir))


_REASONS_SQL = f"""reasons AS (
  SELECT d.doc_id,
         CASE WHEN p.html IS NULL OR octet_length(encode(p.html)) = 0 THEN 'audio_missing'
              WHEN NOT starts_with(p.html, '<!DOCTYPE html>') THEN 'audio_undecodable'
              WHEN d.text IS NULL THEN 'text_missing'
              WHEN length({_sql_strip('d.text')}) = 0 THEN 'text_blank' END AS reject_reason
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)"""


def select_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    led = table(spark, sf_dir, "labels")
    return manifest.select_backlog(d, led, "doc_id", "text", BACKLOG_SIZE).select("doc_id", "n_chars")


def select_backlog_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    led = table(spark, sf_dir, "labels")
    return manifest.select_backlog(d, led, "doc_id", "text", "Full").select("doc_id", "n_chars")


def ledger_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = table(spark, sf_dir, "labels")
    return manifest.ledger_union(led, select_backlog(spark, sf_dir), "doc_id")


_BACKLOG_SQL = """SELECT doc_id, n_chars FROM documents d
  WHERE text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""

# ---- urls ------------------------------------------------------------------------------------


def refresh_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", object_path("url").alias("path"), prefix_missing("url").alias("prefix_missing"))


def refresh_signed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed URLs as the storage gives them out, with the prefix once, twice or not at all."""
    rest = F.substring_index("url", "/", -1)
    signed = F.concat(F.lit("https://h.example:8443"), F.lit(SIGNED_PATH_PREFIX), F.col("page_id"), F.lit("/"), rest, F.lit("?token=a/b;c#d"))
    twice = F.concat(F.lit(SIGNED_PATH_PREFIX), F.lit("x"), F.lit(SIGNED_PATH_PREFIX), F.col("page_id"), F.lit(".mp3;v=1"))
    k = F.col("page_id") % 4
    p = table(spark, sf_dir, "pages").select("page_id", F.when(k < 2, signed).when(k == 2, twice).otherwise(F.col("url")).alias("url"))
    return p.select("page_id", object_path("url").alias("path"), prefix_missing("url").alias("prefix_missing"))


def enrich_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = refresh_paths(spark, sf_dir).select("page_id", "path")
    out = enrich(paths, "page_id", "path", HashSigner(), out_col="new_audio_url", batch_size=1000, backoff=None)
    return out.select("page_id", "path", "new_audio_url", "attempts", "error")


def url_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = split_train_eval(spark, sf_dir)
    return s.select("page_id", file_name("url").alias("file_name"),
                    F.when(F.col("split") == "train", F.lit("training_data")).otherwise(F.lit("evaluation_data"))
                    .alias("target_dir"))


_PATH_SQL = (f"regexp_replace(regexp_extract(url, {_q(URL_PATH_RE)}, 1), ';[^/]*$', '')")
_REFRESH_SQL = f"""paths AS (
  SELECT page_id, 'processed/' || split_part(replace({_PATH_SQL}, {_q(SIGNED_PATH_PREFIX)}, ''), '?', 1) AS path,
         coalesce(NOT contains({_PATH_SQL}, {_q(SIGNED_PATH_PREFIX)}), true) AS prefix_missing
  FROM pages)"""

# ---- sampling --------------------------------------------------------------------------------


def split_train_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return sampling.train_eval_split(p, "url", frac=0.7, seed=SEED, tie_col="page_id")


def sample_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    return sampling.sample_k(d, "doc_id", 180, seed=SEED)


def shuffle_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    return sampling.shuffle_positions(d, "doc_id", epochs=(0, 1), seed=SEED, num_shards=128).select(
        "doc_id", "epoch", "position", "shard")


def interleave_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.interleave(d, "lang", SPLITS, "doc_id").select("doc_id", "lang", "pos", "seq")


def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    return sampling.assign_batches(d, "doc_id", 1000, 32).select("doc_id", "idx", "batch_id", "sub_batch")


_SPLIT_SQL = """ranked AS (SELECT page_id, url, row_number() OVER (ORDER BY md5('42:' || url), page_id) - 1 AS rk,
                   count(*) OVER () AS n FROM pages),
train AS (SELECT page_id, url FROM ranked WHERE rk < round_even(0.7 * n, 0)),
splits AS (SELECT page_id, url, 'train' AS split FROM train
           UNION ALL
           SELECT page_id, url, 'eval' AS split FROM pages p WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.url = p.url))"""

# ---- labels ----------------------------------------------------------------------------------


def _vocab(spark, sf_dir):
    return labels.build_vocab(table(spark, sf_dir, "documents"), "text")


def build_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocab(spark, sf_dir)


def _encoded(spark, sf_dir, vocab=None):
    d = table(spark, sf_dir, "documents")
    return labels.encode(d, vocab if vocab is not None else _vocab(spark, sf_dir), ["doc_id"], "text")


def _ids_string(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def encode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _encoded(spark, sf_dir)
    return e.select("doc_id", _ids_string("labels").alias("labels"), F.size("labels").cast("long").alias("n_labels"))


def decode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocab(spark, sf_dir)
    return labels.decode(_encoded(spark, sf_dir, vocab), vocab, ["doc_id"], "labels", "text")


def _in_batches(spark, sf_dir, encoded):
    """Only the ids are sorted and numbered; the label arrays stay where the encoding left them, by id."""
    ids = sampling.assign_batches(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", COLLATE_BATCH, None)
    return encoded.join(ids, "doc_id")


def collate_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = labels.collate(_in_batches(spark, sf_dir, _encoded(spark, sf_dir)), "batch_id", "labels", start_id=labels.BOS_ID)
    return c.select("doc_id", "batch_id", _ids_string("labels").alias("labels"), "width")


def collate_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of which some hold a row that doesn't begin with the start token: those keep their first column."""
    e = _encoded(spark, sf_dir)
    e = e.withColumn("labels", F.when(F.col("doc_id") % 20 == 0, F.slice("labels", 2, F.size("labels"))).otherwise(F.col("labels")))
    c = labels.collate(_in_batches(spark, sf_dir, e), "batch_id", "labels", start_id=labels.BOS_ID)
    return c.select("doc_id", "batch_id", _ids_string("labels").alias("labels"), "width")


_VOCAB_SQL = f"""vc AS (SELECT word, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(text, {_q(_WORD)})) AS word
                                                 FROM documents) GROUP BY word),
vocab AS (SELECT word, (row_number() OVER (ORDER BY freq DESC, word) - 1 + 4)::INTEGER AS id, freq FROM vc),
toks AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p
         FROM (SELECT doc_id, regexp_extract_all(text, {_q(_WORD)}) AS w FROM documents)),
enc0 AS (SELECT t.doc_id, list(coalesce(v.id, 3) ORDER BY t.p) AS ids
         FROM toks t LEFT JOIN vocab v ON v.word = t.word GROUP BY t.doc_id),
enc AS (SELECT d.doc_id, [1] || coalesce(e.ids, []) || [2] AS ids FROM documents d LEFT JOIN enc0 e ON e.doc_id = d.doc_id)"""

# ---- features --------------------------------------------------------------------------------


def audio_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", features.audio_seconds("embedding").alias("input_length"))


def log_mel(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    # the embedding values as a short PCM clip at 16 kHz
    return features.log_mel_from_samples(e, "vec_id", "embedding", summary=True).select(
        "vec_id", "input_length", "n_mels", "n_frames", F.round("feat_mean", 4).alias("feat_mean"),
        F.round("feat_max", 4).alias("feat_max"))


def wav_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embedding values stored as 8 kHz 16-bit WAV objects, then decoded, resampled to 16 kHz
    and turned into log-Mel features (the full decode path)."""
    e = table(spark, sf_dir, "embeddings")
    audio = e.select("vec_id", features.wav_bytes("embedding", rate=8000).alias("audio"))
    return features.log_mel_features(audio, "vec_id", "audio", summary=True).select(
        "vec_id", "input_length", "n_mels", "n_frames", "reject_reason")


MANIFEST_SHAPES = 9


def _manifest(spark, sf_dir):
    """embeddings as audio (a data URL of WAV bytes) with the text of the document of the same number;
    by number modulo 9: an unreachable location (1), no bytes (2), bytes that are no WAV (3), text
    without a word (4), blank text (5), no text (6)."""
    e, d = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    k = F.col("vec_id") % MANIFEST_SHAPES
    audio = F.base64(features.wav_bytes("embedding", rate=16000))
    rows = e.select(F.col("vec_id").alias("id"), k.alias("k"), F.when(k == 1, F.lit("gone")).when(k == 2, F.lit("data:"))
                    .when(k == 3, F.lit("data:QUJD")).otherwise(F.concat(F.lit("data:"), audio)).alias("new_audio_url"))
    text = F.when(F.col("k") == 4, F.lit("?!")).when(F.col("k") == 5, F.lit(" \t")).when(F.col("k") != 6, F.col("text"))
    return rows.join(d, "id").select("id", "new_audio_url", text.alias("transcription"))


def data_url_loader(location: str) -> bytes:
    import base64
    if not location.startswith("data:"):
        raise OSError(f"no such object: {location}")
    return base64.b64decode(location[5:])


def frame_levels(data: bytes):
    """A small feature function: mean level of each frame of 160 samples, in one row."""
    try:
        samples, rate, channels = features.read_wav(data)
    except Exception as e:  # noqa: BLE001
        raise preparation.Reject("audio_undecodable") from e
    if channels > 1:
        raise preparation.Reject("multi_channel")
    mono = samples[:, 0]
    return [[float(abs(mono[i:i + 160]).mean()) for i in range(0, len(mono), 160)]], len(mono) / rate


def prepare_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preparation job from manifest to feature table, run twice: the first takes the ids below
    the middle, the second resumes with the rest. All rows of the table come back."""
    out, manifest, vocab = scratch_path(spark, "features"), _manifest(spark, sf_dir), _vocab(spark, sf_dir)
    half = manifest.where("id % 2 = 0")
    for run, rows in (("first", half), ("second", manifest)):
        preparation.prepare_features_batch(spark, rows, out, run, data_url_loader, frame_levels, vocab, delay=0)
    return preparation.prepared(spark, out, None).select(
        "id", F.round("input_length", 6).alias("input_length"), F.size(F.get("input_features", F.lit(0))).alias("n_frames"),
        _ids_string("labels").alias("labels"), "reject_reason", "run")


def ledger_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest arrives in five batches that overlap; each id is entered once, by the first batch that brings it."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    led = ledger.Ledger(spark, scratch_path(spark, "ledger"), docs.schema["id"].dataType)
    for k in range(5):
        batch = docs.where((F.col("id") % 5).isin(k, (k + 1) % 5) | (F.col("id") % 7 == k))
        led.add(led.unseen(batch), f"batch-{k}")
        led.commit(f"batch-{k}")
        if k == 2:
            led.compact()
    return led.ids().select("id", F.when(F.col("run").startswith("base"), F.lit("base")).otherwise(F.col("run")).alias("run"))


def _collate_sql(ids: str) -> str:
    return f"""WITH {_VOCAB_SQL},
        b AS (SELECT doc_id, {ids} AS ids, (row_number() OVER (ORDER BY doc_id) - 1) // {COLLATE_BATCH} AS batch_id FROM enc),
        w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS wd,
                        bool_and(coalesce(ids[1] = 1, false)) OVER (PARTITION BY batch_id) AS cut FROM b),
        p AS (SELECT *, ids || list_transform(range(wd - len(ids)), lambda x: -100) AS padded FROM w)
        SELECT doc_id, batch_id, array_to_string(CASE WHEN cut THEN padded[2:] ELSE padded END, ',') AS labels,
               (wd - cut::INTEGER)::BIGINT AS width FROM p"""


_HEAD_LIST = "[" + ", ".join("NULL" if h is None else f"'{h}'" for h in AUDIO_HEADS) + "]"
_SIGNED_URL = f"""CASE WHEN page_id % 4 < 2 THEN 'https://h.example:8443{SIGNED_PATH_PREFIX}' || page_id || '/' || string_split(url, '/')[-1] || '?token=a/b;c#d'
        WHEN page_id % 4 = 2 THEN '{SIGNED_PATH_PREFIX}x{SIGNED_PATH_PREFIX}' || page_id || '.mp3;v=1' ELSE url END"""

# ---- streaming -------------------------------------------------------------------------------


def stream_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream-prepare-out")
    ckpt = scratch_path(spark, "stream-prepare-ckpt")
    stream.prepare_stream(spark, stream.one_table(sf_dir, "documents.parquet"), out, ckpt, id_col="doc_id", text_col="text")
    return stream.prepared_rows(spark, out).select("doc_id", "text", "n_chars")


_PUNCT_TO_SPACE = (f"regexp_replace(lower({_sql_strip('text')}), "
                   f"{_q('[^' + T.WORD_CLASS_BODY + T.WS_CLASS_BODY + ']')}, ' ', 'g')")

ORACLES = {
    "ledger_batches": """
WITH b AS (SELECT doc_id AS id, k FROM documents, (SELECT unnest(range(5)) AS k)
           WHERE doc_id % 5 IN (k, (k + 1) % 5) OR doc_id % 7 = k)
SELECT id, CASE WHEN min(k) <= 2 THEN 'base' ELSE 'batch-' || min(k) END AS run FROM b GROUP BY id""",
    "word_edits": f"WITH {_scored_sql(False)} SELECT conv_id, turn, edits, ref_words, hyp_words FROM scored",
    "corpus_wer": f"WITH {_scored_sql(False)} {_WER_SELECT}",
    "corpus_wer_normalized": f"WITH {_scored_sql(True)} {_WER_SELECT}",
    "clean_transcription": f"""SELECT doc_id, {_sql_strip('text')} AS text_stripped,
        {_sql_strip(_PUNCT_TO_SPACE)} AS text_clean
        FROM documents""",
    "normalize_for_scoring": f"SELECT doc_id, {_sql_normalize('text')} AS normalized FROM documents",
    "reject_reasons": f"WITH {_REASONS_SQL} SELECT doc_id, reject_reason FROM reasons",
    "reject_counts": f"""WITH {_REASONS_SQL}
        SELECT coalesce(reject_reason, 'ok') AS outcome, count(*) AS n FROM reasons GROUP BY 1""",
    "select_backlog": f"{_BACKLOG_SQL} ORDER BY doc_id LIMIT {BACKLOG_SIZE}",
    "select_backlog_full": _BACKLOG_SQL,
    "ledger_union": f"""SELECT doc_id FROM labels UNION
        SELECT doc_id FROM ({_BACKLOG_SQL} ORDER BY doc_id LIMIT {BACKLOG_SIZE})""",
    "refresh_paths": f"WITH {_REFRESH_SQL} SELECT page_id, path, prefix_missing FROM paths",
    "enrich_urls": f"""WITH {_REFRESH_SQL}
        SELECT page_id, path, 'https://storage.example/sign/' || path || '?token=' || substr(md5(path || ':604800'), 1, 16)
               AS new_audio_url, 1::INTEGER AS attempts, NULL::VARCHAR AS error FROM paths""",
    "split_train_eval": f"WITH {_SPLIT_SQL} SELECT page_id, url, split FROM splits",
    "url_manifest": f"""WITH {_SPLIT_SQL}
        SELECT page_id, split_part(split_part(url, '?', 1), '/', -1) AS file_name,
               CASE WHEN split = 'train' THEN 'training_data' ELSE 'evaluation_data' END AS target_dir FROM splits""",
    "sample_k": "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id::VARCHAR), doc_id LIMIT 180",
    "shuffle_epoch": """SELECT doc_id, epoch::INTEGER AS epoch,
               row_number() OVER (PARTITION BY epoch ORDER BY md5('42:' || epoch || ':' || doc_id), doc_id) - 1 AS position,
               (('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 128)::INTEGER AS shard
        FROM documents, (VALUES (0), (1)) e(epoch)""",
    "interleave_splits": """WITH s AS (
          SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
                 list_position(['en', 'fr', 'de', 'es'], lang) - 1 AS si
          FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')),
        m AS (SELECT min(c) AS r FROM (SELECT lang, count(*) AS c FROM s GROUP BY lang))
        SELECT doc_id, lang, pos, pos * 4 + si AS seq FROM s, m WHERE pos < m.r""",
    "batch_assign": """SELECT doc_id, idx, idx // 1000 AS batch_id, (idx % 1000) // 32 AS sub_batch
        FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)""",
    "build_vocab": f"WITH {_VOCAB_SQL} SELECT word, id, freq FROM vocab",
    "encode_labels": f"""WITH {_VOCAB_SQL}
        SELECT doc_id, array_to_string(ids, ',') AS labels, len(ids)::BIGINT AS n_labels FROM enc""",
    "decode_labels": f"""WITH {_VOCAB_SQL},
        ex AS (SELECT doc_id, unnest(list_filter(ids, lambda x: x >= 4)) AS id,
                      generate_subscripts(list_filter(ids, lambda x: x >= 4), 1) AS p FROM enc),
        dec AS (SELECT ex.doc_id, string_agg(coalesce(v.word, '<unk>'), ' ' ORDER BY ex.p) AS text
                FROM ex LEFT JOIN vocab v ON v.id = ex.id GROUP BY ex.doc_id)
        SELECT d.doc_id, coalesce(dec.text, '') AS text FROM documents d LEFT JOIN dec ON dec.doc_id = d.doc_id""",
    "collate_batches": _collate_sql("ids"),
    "collate_mixed": _collate_sql("CASE WHEN doc_id % 20 = 0 THEN ids[2:] ELSE ids END"),
    "refresh_signed_paths": "WITH " + _REFRESH_SQL.replace("FROM pages", f"FROM (SELECT page_id, {_SIGNED_URL} AS url FROM pages)")
                            + " SELECT page_id, path, prefix_missing FROM paths",
    "reject_formats": f"""
WITH h AS (SELECT doc_id, {_HEAD_LIST}[doc_id % {len(AUDIO_HEADS)} + 1] AS head,
             CASE WHEN doc_id % 5 = 1 THEN ' ' || chr(9) || chr(10) WHEN doc_id % 5 <> 0 THEN text END AS text FROM documents),
f AS (SELECT *, CASE WHEN head LIKE '52494646________57415645%' THEN 'wav' WHEN head LIKE '664C6143%' THEN 'flac'
             WHEN head LIKE '4F676753%' THEN 'ogg' WHEN head LIKE '494433%' OR head LIKE 'FFFB%' THEN 'mp3' END AS format FROM h)
SELECT doc_id, format, CASE WHEN head IS NULL OR head = '' THEN 'audio_missing' WHEN format IS NULL THEN 'audio_undecodable'
  WHEN text IS NULL THEN 'text_missing' WHEN {_sql_strip('text')} = '' THEN 'text_blank' END AS reject_reason FROM f""",
    "audio_seconds": "SELECT vec_id, len(embedding)::DOUBLE / 16000 AS input_length FROM embeddings",
    "prepare_features": f"""WITH {_VOCAB_SQL},
        m AS (SELECT vec_id AS id, vec_id % {MANIFEST_SHAPES} AS k, len(embedding) AS n, text
              FROM embeddings JOIN documents ON doc_id = vec_id WHERE vec_id % {MANIFEST_SHAPES} <> 6 AND text IS NOT NULL),
        r AS (SELECT m.*, ids, CASE WHEN k = 1 THEN 'load_failed' WHEN k = 2 THEN 'audio_missing' WHEN k = 3 THEN 'audio_undecodable'
                     WHEN k = 5 OR trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'text_blank' WHEN k = 4 OR len(ids) <= 2 THEN 'tokenize_error' END AS reject_reason
              FROM m JOIN enc ON enc.doc_id = m.id)
        SELECT id, CASE WHEN reject_reason IS NULL THEN round(n / 16000.0, 6) END AS input_length,
               CASE WHEN reject_reason IS NULL THEN ceil(n / 160.0)::INTEGER END AS n_frames,
               CASE WHEN reject_reason IS NULL THEN array_to_string(ids, ',') END AS labels, reject_reason, run
        FROM r JOIN (VALUES ('first'), ('second')) t(run)
          ON CASE run WHEN 'first' THEN id % 2 = 0 ELSE id % 2 = 1 OR reject_reason IS NOT NULL END""",
    "wav_features": """SELECT vec_id, (2 * len(embedding))::DOUBLE / 16000 AS input_length, 80 AS n_mels,
                              3000 AS n_frames, NULL::VARCHAR AS reject_reason FROM embeddings""",
    "stream_prepare": f"""SELECT doc_id, {_sql_strip('text')} AS text, n_chars FROM documents
        WHERE text IS NOT NULL AND length({_sql_strip('text')}) > 0""",
}

QUERIES = {
    "collate_mixed": collate_mixed,
    "refresh_signed_paths": refresh_signed_paths,
    "reject_formats": reject_formats,
    "ledger_batches": ledger_batches,
    "word_edits": word_edits,
    "corpus_wer": corpus_wer,
    "corpus_wer_normalized": corpus_wer_normalized,
    "clean_transcription": clean_transcription,
    "normalize_for_scoring": normalize_for_scoring,
    "reject_reasons": reject_reasons,
    "reject_counts": reject_counts,
    "select_backlog": select_backlog,
    "select_backlog_full": select_backlog_full,
    "ledger_union": ledger_union,
    "refresh_paths": refresh_paths,
    "enrich_urls": enrich_urls,
    "url_manifest": url_manifest,
    "split_train_eval": split_train_eval,
    "sample_k": sample_k,
    "shuffle_epoch": shuffle_epoch,
    "interleave_splits": interleave_splits,
    "batch_assign": batch_assign,
    "build_vocab": build_vocab,
    "encode_labels": encode_labels,
    "decode_labels": decode_labels,
    "collate_batches": collate_batches,
    "audio_seconds": audio_seconds,
    "log_mel": log_mel,
    "wav_features": wav_features,
    "prepare_features": prepare_features,
    "stream_prepare": stream_prepare,
}

