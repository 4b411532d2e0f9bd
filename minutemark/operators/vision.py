"""Who is highlighted in a gallery frame: numpy on pixels inside Arrow tasks, one row for each frame.

A frames table has meeting, frame_ord, t_us, height, width, pixels (rows of
BGR bytes). The text reader is any object with ``read(crop) -> (text,
confidence, right extent from 0 to 1)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_SPEAKER = "No Speaker"

# ---- Fixed values: what a highlight looks like, and where its name stands ----

HUE, LEAST_VALUE, SATURATION_FLOORS = (25, 90), 150, (150, 100, 70)
LEAST_WIDTH, LEAST_HEIGHT, AREA_SHARE, ASPECT = 60, 40, (0.01, 0.75), (0.9, 2.8)
MOST_INSIDE, SECOND_SIDE, MEAN_SIDES = 0.06, 0.5, 0.6
CORNER, NAME_HEIGHT, NAME_WIDTH, CORNER_NAME_WIDTH, BOTTOM = 0.18, 0.22, 0.5, 0.9, 2
FULL_EXTENT, CONFIDENCE_SLACK = 0.92, 0.1

# ---- End of the fixed values ----


class Reader(Protocol):
    def read(self, crop: np.ndarray) -> tuple[str, float, float]: ...


def _shifted(mask: np.ndarray, combine, edge: bool) -> np.ndarray:
    """Combine each pixel with its eight neighbours."""
    h, w = mask.shape
    padded = np.pad(mask, 1, constant_values=edge)
    out = mask.copy()
    for dy in range(3):
        for dx in range(3):
            combine(out, padded[dy : dy + h, dx : dx + w], out=out)
    return out


def highlight_mask(frame: np.ndarray, least_saturation: int = 150) -> np.ndarray:
    """Pixels of the highlight's green, after closing gaps of a pixel; hue is in half degrees."""
    bgr = frame.astype(np.int32)
    high, low = bgr.max(2), bgr.min(2)
    spread = high - low
    safe = np.maximum(spread, 1)
    blue, green, red = bgr[..., 0], bgr[..., 1], bgr[..., 2]
    hue = np.where(high == red, 30.0 * (green - blue) / safe, np.where(high == green, 60 + 30.0 * (blue - red) / safe, 120 + 30.0 * (red - green) / safe))
    hue = np.where(spread == 0, 0, np.rint(np.where(hue < 0, hue + 180, hue)))
    saturation = np.rint(255.0 * spread / np.maximum(high, 1))
    mask = (hue >= HUE[0]) & (hue <= HUE[1]) & (saturation >= least_saturation) & (high >= LEAST_VALUE)
    return _shifted(_shifted(mask, np.logical_or, False), np.logical_and, True)


def component_boxes(mask: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Bounding boxes (x, y, width, height) of the mask's connected parts, corners touching too.

    Each row's runs of pixels are joined with the runs above that they touch.
    """
    parent: list[int] = []
    boxes: list[list[int]] = []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    above: list[tuple[int, int, int]] = []
    for y in np.flatnonzero(mask.any(1)).tolist():
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask[y].view(np.int8), [0]))))
        runs = []
        old = [r for r in above if boxes[find(r[2])][3] >= y] if above else []
        j = 0
        for a, b in edges.reshape(-1, 2).tolist():
            me = len(parent)
            parent.append(me)
            boxes.append([a, y, b, y + 1])
            while j < len(old) and old[j][1] < a:
                j += 1
            k = j
            while k < len(old) and old[k][0] <= b:
                root, mine = find(old[k][2]), find(me)
                if root != mine:
                    parent[mine] = root
                    p, q = boxes[root], boxes[mine]
                    boxes[root] = [min(p[0], q[0]), min(p[1], q[1]), max(p[2], q[2]), max(p[3], q[3])]
                k += 1
            runs.append((a, b, me))
        above = runs
    return [(b[0], b[1], b[2] - b[0], b[3] - b[1]) for i, b in enumerate(boxes) if parent[i] == i]


def outline_box(mask: np.ndarray) -> tuple[int, int, int, int] | None:
    """The largest box that is a rectangle's outline: thin, empty inside, at least three sides covered."""
    height, width = mask.shape
    sums = np.zeros((height + 1, width + 1), np.int64)
    np.cumsum(np.cumsum(mask, 0), 1, out=sums[1:, 1:])

    def share(x0: int, y0: int, x1: int, y1: int) -> float:
        if x1 <= x0 or y1 <= y0:
            return 0.0
        return (sums[y1, x1] - sums[y0, x1] - sums[y1, x0] + sums[y0, x0]) / ((x1 - x0) * (y1 - y0))

    best = None
    for x, y, w, h in component_boxes(mask):
        if w < LEAST_WIDTH or h < LEAST_HEIGHT or not ASPECT[0] <= w / h <= ASPECT[1]:
            continue
        if not AREA_SHARE[0] <= w * h / (width * height) <= AREA_SHARE[1] or (best and w * h <= best[2] * best[3]):
            continue
        thick = max(2, min(5, round(min(w, h) * 0.02)))
        if share(x + 2 * thick, y + 2 * thick, x + w - 2 * thick, y + h - 2 * thick) > MOST_INSIDE:
            continue
        sides = sorted((share(x, y, x + w, y + thick), share(x, y + h - thick, x + w, y + h), share(x, y, x + thick, y + h), share(x + w - thick, y, x + w, y + h)))
        if sides[1] >= SECOND_SIDE and sum(sides[1:]) / 3 >= MEAN_SIDES:
            best = (x, y, w, h)
    return best


def highlight_box(frame: np.ndarray) -> tuple[tuple[int, int, int, int] | None, int | None]:
    """The highlight and the saturation at which it was found, strict colours first."""
    for floor in SATURATION_FLOORS:
        if box := outline_box(highlight_mask(frame, floor)):
            return box, floor
    return None, None


def without_border(frame: np.ndarray, threshold: int = 10) -> np.ndarray:
    """The frame without black bars; an all-black frame stays whole."""
    lit = (frame > threshold).any(2)
    rows, columns = np.flatnonzero(lit.any(1)), np.flatnonzero(lit.any(0))
    return frame[rows[0] : rows[-1] + 1, columns[0] : columns[-1] + 1] if len(rows) else frame


def speaker_tile(frame: np.ndarray) -> tuple[tuple[int, int, int, int], str, int | None, np.ndarray]:
    """Box (in the frame without bars), detection, saturation floor, and the tile: the highlighted one, else the top right corner."""
    frame = without_border(frame)
    height, width = frame.shape[:2]
    box, floor = highlight_box(frame)
    detection = "grid" if box else "overlay"
    x, y, w, h = box = box or (width - int(width * CORNER), 0, int(width * CORNER), int(height * CORNER))
    return box, detection, floor, frame[y : y + h, x : x + w]


def annotated(frame: np.ndarray, box: tuple[int, int, int, int], colour: tuple[int, int, int], thick: int = 3) -> np.ndarray:
    """A copy of the frame with the box drawn on it."""
    out, (x, y, w, h) = frame.copy(), box
    out[max(0, y - 1) : y + thick - 1, x : x + w] = out[y + h - 1 : y + h + thick - 2, x : x + w] = colour
    out[y : y + h, max(0, x - 1) : x + thick - 1] = out[y : y + h, x + w - 1 : x + w + thick - 2] = colour
    return out


def name_strip(tile: np.ndarray, width: float = NAME_WIDTH, height: float = NAME_HEIGHT) -> np.ndarray:
    h, w = tile.shape[:2]
    return tile[h - int(h * height) : h - BOTTOM, : int(w * width)]


def read_name(frame: np.ndarray, reader: Reader) -> tuple[str, float, str, tuple[int, int, int, int]]:
    """name, confidence, detection, box; text that runs to the strip's right edge is read again over the tile's whole width."""
    box, detection, _, tile = speaker_tile(frame)
    if not tile.size:
        return NO_SPEAKER, 0.0, detection, box
    text, confidence, extent = reader.read(name_strip(tile, NAME_WIDTH if detection == "grid" else CORNER_NAME_WIDTH))
    if text and extent >= FULL_EXTENT:
        wide, sure, _ = reader.read(name_strip(tile, 1.0))
        if len(wide) > len(text) and sure >= confidence - CONFIDENCE_SLACK:
            text, confidence = wide, sure
    return text or NO_SPEAKER, confidence, detection, box


class Escalating:
    """A reader that reads an enlarged crop where the first reading is neither sure nor hopeless, and keeps the surer one."""

    def __init__(self, first: Reader, enlarge, sure: float = 0.8, noise: float = 0.1):
        self.first, self.enlarge, self.sure, self.noise = first, enlarge, sure, noise

    def read(self, crop: np.ndarray) -> tuple[str, float, float]:
        found = self.first.read(crop)
        if self.noise < found[1] < self.sure:
            larger = self.enlarge(crop)
            if larger is not None:
                second = self.first.read(larger)
                return second if second[1] > found[1] else found
        return found


def enlarge(crop: np.ndarray, factor: int = 4) -> np.ndarray:
    """The crop enlarged by repeating pixels; a stand-in for a super-resolution model."""
    return crop.repeat(factor, 0).repeat(factor, 1)


def join_boxes(boxes: list[tuple[str, float, float, float]], width: float) -> tuple[str, float, float]:
    """Text boxes (text, score, left, right) of one crop as a reading: from left to right, mean score, extent."""
    boxes = sorted((b for b in boxes if b[0].strip()), key=lambda b: b[2])
    if not boxes:
        return "", 0.0, 0.0
    return " ".join(b[0].strip() for b in boxes), sum(b[1] for b in boxes) / len(boxes), max(b[3] for b in boxes) / max(width, 1)


def _image(row: dict) -> np.ndarray:
    return np.frombuffer(row["pixels"], np.uint8).reshape(row["height"], row["width"], 3)


def read_frames(frames: DataFrame, reader: Reader) -> DataFrame:
    """meeting, ord, t_us, name, confidence, detection, box: a frame that fails is a row with detection 'error'.

    A row without pixels, by which a source tells a video that it could not read to the end, has detection 'unreadable'.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box_type = pa.struct([(c, pa.int32()) for c in ("x", "y", "w", "h")])
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string(), box_type]
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if row["pixels"] is None:
                    rows.append((row["meeting"], row["frame_ord"], row["t_us"], NO_SPEAKER, 0.0, "unreadable", None))
                    continue
                try:
                    name, confidence, detection, box = read_name(_image(row), reader)
                    box = dict(zip("xywh", map(int, box)))
                except Exception:  # one bad frame is not the video's end
                    name, confidence, detection, box = NO_SPEAKER, 0.0, "error", None
                rows.append((row["meeting"], row["frame_ord"], row["t_us"], name, confidence, detection, box))
            if rows:
                names = ["meeting", "ord", "t_us", "name", "confidence", "detection", "box"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    columns = frames.select(F.col("meeting").cast("string"), "frame_ord", "t_us", "height", "width", "pixels")
    return columns.mapInArrow(
        run, "meeting string, ord long, t_us long, name string, confidence double, detection string, box struct<x: int, y: int, w: int, h: int>"
    )


def preflight(reader: Reader, crop: np.ndarray) -> None:
    """Fail before the job if the reader reads nothing where text is."""
    if not reader.read(crop)[0].strip():
        raise RuntimeError("the text reader returned nothing for a plain label")
