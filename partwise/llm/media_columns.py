"""Media columns: interleaved document sequences with payloads resolved by digest.

An HTML page is parsed into an ordered sequence of structs, texts and references to media with their captions. Media
are kept once in a store, by the digest of their content, as binary PGM images (8-bit samples, 192 a row). References
are joined with the store by digest, and the position and caption of each stay with it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm._batches import stored

WIDTH = 192
SCHEME = "media:"
PART = "struct<position:int,kind:string,text:string,digest:string,caption:string>"
STORE = "digest string, media binary"
RESOLVED = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


class _Figure:
    """An open figure: its first part, whether its caption is open, the caption, and the part before which it stands."""

    def __init__(self, start: int):
        self.start = self.place = start
        self.open = False
        self.caption: list[str] = []


class _Sequence(HTMLParser):
    """Texts and media references of a page in order; a figure's caption goes to its media.

    Scripts, styles, templates and the head give no text; media in <noscript> count, as pages put them there for readers
    without scripts, media in a template do not.
    """

    HIDDEN = {"script", "style", "template", "noscript"}
    HEAD = HIDDEN | {"title", "base", "link", "meta", "noframes", "basefont", "bgsound", "html", "head"}
    BREAKS = {"p", "div", "li", "tr", "br", "figure", "article", "section", "blockquote", *(f"h{i}" for i in range(1, 7))}
    MEDIA = {"img", "audio", "video", "source", "embed"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[dict] = []
        self.words: list[str] = []
        self.hidden = self.templates = 0
        self.head = self.title = False
        self.figures: list[_Figure] = []  # open ones, the innermost last
        self.captioned: set[int] = set()

    def text_ends(self) -> None:
        text = " ".join("".join(self.words).split())
        self.words = []
        if text:
            self.parts.append({"kind": "text", "text": text, "digest": None, "caption": None})

    def head_ends(self) -> None:
        self.head, self.title, self.hidden = False, False, 0

    def figure_ends(self) -> None:
        """The caption goes to the figure's media without one, or is a text at its place."""
        figure = self.figures.pop()
        said = " ".join("".join(figure.caption).split())
        media = [p for p in self.parts[figure.start :] if p["kind"] == "media" and id(p) not in self.captioned]
        for part in media if said else ():
            part["caption"] = said
            self.captioned.add(id(part))
        if said and not media:
            self.parts.insert(figure.place, {"kind": "text", "text": said, "digest": None, "caption": None})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.head and (tag == "body" or not self.hidden and tag not in self.HEAD):  # </head> may be left out
            self.head_ends()
        if tag == "head":
            self.head = True
        if tag in self.HIDDEN:
            self.hidden += 1
            self.templates += tag == "template"
        if tag == "title" and self.head and not self.title:
            self.title = True
            self.hidden += 1
        if tag in self.BREAKS or tag in self.MEDIA or tag == "figcaption":
            self.text_ends()
        if tag == "figure":
            self.figures.append(_Figure(len(self.parts)))
        if tag == "figcaption" and self.figures:
            figure = self.figures[-1]
            figure.open, figure.place = True, figure.place if figure.caption else len(self.parts)
            figure.caption.append(" ")
        found = dict(attrs)
        if tag in self.MEDIA and not self.templates and (source := found.get("src") or ""):
            digest = source[len(SCHEME) :] if source.startswith(SCHEME) else hashlib.sha256(source.encode()).hexdigest()
            self.parts.append({"kind": "media", "text": None, "digest": digest, "caption": found.get("alt")})

    def handle_endtag(self, tag: str) -> None:
        if tag == "head" and self.head:
            self.head_ends()
        if (tag in self.HIDDEN or tag == "title" and self.title) and self.hidden:
            self.hidden -= 1
            self.templates -= tag == "template" and self.templates > 0
        if tag == "title":
            self.title = False
        if tag == "figcaption":
            if self.figures:
                self.figures[-1].open = False
            self.text_ends()
        if tag in self.BREAKS:
            self.text_ends()
        if tag == "figure" and self.figures:
            self.figure_ends()

    def handle_data(self, data: str) -> None:
        if self.head and not self.hidden and data.strip():
            self.head_ends()
        if not self.hidden and not self.head:
            (self.figures[-1].caption if self.figures and self.figures[-1].open else self.words).append(data)

    def page_ends(self) -> None:
        self.text_ends()
        while self.figures:
            self.figure_ends()


def sequence(page: str | None) -> list[dict]:
    parser = _Sequence()
    parser.feed(page or "")
    parser.close()
    parser.page_ends()
    return [{"position": i, **part} for i, part in enumerate(parser.parts)]


def interleaved(pages: DataFrame, key: str, html_column: str) -> DataFrame:
    """(key, parts): the ordered texts and media references of each page.

    A null or empty page has none, repeated rows are each returned, a null key stays null, an empty table gives an empty
    result; other columns are ignored.
    """
    kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sequence(p) for p in batch.column(1).to_pylist()], kind)], [key, "parts"])

    source = pages.select(F.col(key).cast("long"), F.col(html_column).cast("string"))
    return source.mapInArrow(run, f"{key} long, parts array<{PART}>")


def payload_of(text: bytes) -> bytes:
    """A text's bytes, filled up with spaces to whole rows of samples, one at least."""
    return text.ljust(max(WIDTH, -(-len(text) // WIDTH) * WIDTH))


def stored_form(payload: bytes) -> bytes:
    return b"P5\n%d %d\n255\n" % (WIDTH, len(payload) // WIDTH) + payload


def samples(media: bytes) -> bytes:
    """The samples of a stored image."""
    magic, size, _, payload = media.split(b"\n", 3)
    width, height = map(int, size.split())
    if magic != b"P5" or len(payload) != width * height:
        raise ValueError("not a whole 8-bit image")
    return payload


def feature(payload: bytes) -> str:
    """Rows, mean and spread of the samples in thousandths, and a 64-bit average hash of an 8 by 8 thumbnail."""
    pixels = np.frombuffer(payload, np.uint8)
    grid = pixels.reshape(-1, WIDTH)
    bounds = np.linspace(0, len(grid), 9).astype(int)
    columns = grid.reshape(len(grid), 8, WIDTH // 8).sum(2, dtype=np.int64)
    running = np.concatenate([np.zeros((1, 8), np.int64), np.cumsum(columns, 0)])
    low = np.minimum(bounds[:-1], len(grid) - 1)
    high = np.maximum(bounds[1:], low + 1)
    cells = (running[high] - running[low]) / ((high - low)[:, None] * (WIDTH // 8))
    bits = "".join("1" if b else "0" for b in (cells > cells.mean()).ravel())
    total, square = int(pixels.sum(dtype=np.int64)), int((pixels.astype(np.int64) ** 2).sum())
    n = len(pixels)
    return f"{len(grid)}x{WIDTH};mean={1000 * total // n};var={1000 * (square * n - total * total) // (n * n)};ahash={int(bits, 2):016x}"


def media_store(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts' payloads as a store of (digest, media), and (doc_id, n_bytes, digest) references to them.

    A null text counts as empty, a null doc_id stays null, repeated rows are references each. A task stores a payload once, so a payload is stored at most once a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for k in range(0, len(texts), 256):
                ids, sizes, digests, media = batch.column(0).slice(k, 256), [], [], []
                for text in texts[k : k + 256]:
                    payload = payload_of(text or b"")
                    digest = hashlib.sha256(payload).hexdigest()
                    sizes.append(len(text or b""))
                    digests.append(digest)
                    media.append(None if digest in seen else stored_form(payload))
                    seen.add(digest)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(digests), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "digest", "media"])

    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    both = stored(docs.mapInArrow(run, "doc_id long, n_bytes long, digest string, media binary"))
    return both.where("media is not null").select("digest", "media"), both.select("doc_id", "n_bytes", "digest")


def resolved(store: DataFrame) -> DataFrame:
    """One row per digest, from the stored bytes: sizes, digests and the feature of the samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for digest, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                payload = samples(media)
                rows.append((digest, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(payload)))
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return stored(store.mapInArrow(run, RESOLVED).dropDuplicates(["digest"]))


def resolve(parts: DataFrame, key: str, media: DataFrame) -> DataFrame:
    """(key, position, caption, digest, ... media columns): each media reference of parts with what it refers to.

    A reference to media that are not in the store keeps its position and caption, with nulls. A key may have any name;
    it is the first column of the result.
    """
    wanted = parts.select(F.col(key).alias("_key"), F.explode("parts").alias("p")).where("p.kind = 'media'").select("_key", "p.position", "p.caption", "p.digest")
    found = wanted.join(media, "digest", "left")
    rest = [c for c in found.columns if c not in ("_key", "position", "caption", "digest")]
    return found.select("_key", "position", "caption", "digest", *rest).toDF(key, "position", "caption", "digest", *rest)


def document_media(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) of every row.

    Each text is stored as an image and stands in an interleaved page of its own, whose reference is parsed and
    resolved by digest. A null or empty text is a payload of one row of spaces; equal texts share one stored form;
    repeated rows are each returned; an empty table gives an empty result; other columns are ignored.
    """
    store, references = media_store(documents)
    page = F.concat(F.lit("<article><p>"), F.coalesce(F.col("n_bytes").cast("string"), F.lit("")), F.lit(f'</p><figure><img src="{SCHEME}'), F.col("digest"), F.lit('"><figcaption>'), F.col("n_bytes").cast("string"), F.lit("</figcaption></figure></article>"))
    parts = stored(interleaved(references.withColumn("html", page), "doc_id", "html"))
    found = resolve(parts, "doc_id", resolved(store))
    return found.select("doc_id", F.col("caption").cast("long").alias("n_bytes"), "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
