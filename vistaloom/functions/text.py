"""Text functions: metadata lines, matrices, paths, points, captions, keys and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

#: Short names of the skills; of others, the first three letters.
CODES = {
    "anchor": "anc",
    "counting": "cnt",
    "cross_depth_variation": "cdv",
    "cross_object_correspondence": "coc",
    "cross_occlusion_visibility": "cov",
    "cross_point_correspondence": "cpc",
    "cross_spatial_transformation": "cst",
    "relative_direction": "rdr",
    "relative_distance": "rdi",
}


def meta(text: Column) -> Column:
    """A map of the lines `key = value`; other lines don't count, and of equal keys the last holds."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^\w+\s*=\s*.+$"))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"^(\w+)\s*=", 1).alias("k"), F.trim(F.regexp_extract(x, r"^\w+\s*=\s*(.+)$", 1)).alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"])))


def matrix(text: Column) -> Column:
    """Numbers of a text with spaces, line ends or commas between them."""
    parts = F.split(F.trim(F.regexp_replace(text, r"[\s,]+", " ")), " ")
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: x.cast("double"))


def without_comment(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, "#.*$", ""))


def scene_part(path: Column) -> Column:
    """The first part of a path that names a scene of a known source; null without one."""
    parts = F.filter(F.split(path, "/"), lambda p: p.rlike(r"^scene\d{4}_\d{2}$") | p.rlike(r"^[0-9a-f]{10}$"))
    return F.get(parts, F.lit(0))


def source_of(path: Column) -> Column:
    part = scene_part(path)
    return F.when(part.startswith("scene"), "scannet").when(part.isNotNull(), "scannet++").otherwise("unknown")


def points(text: Column) -> Column:
    """Pairs of whole numbers in square brackets."""
    form = r"\[\s*(\d+)\s*,\s*(\d+)\s*\]"
    x, y = (F.transform(F.regexp_extract_all(text, F.lit(form), F.lit(k)), lambda v: v.cast("int")) for k in (1, 2))
    return F.zip_with(x, y, lambda a, b: F.struct(a.alias("x"), b.alias("y")))


def identity(canonical: Column, label: Column) -> Column:
    named = F.trim(F.coalesce(canonical, F.lit("")))
    return F.when(named != "", named).otherwise(F.trim(F.coalesce(label, F.lit(""))))


def shown(label: Column, name: Column) -> Column:
    """A label, with the identity that it is matched by where that is another one."""
    return F.when((name != "") & (name != F.lower(label)), F.concat(label, F.lit("/"), name)).otherwise(label)


def caption(idx: Column, src_label: Column, src_canonical: Column, tgt_label: Column, tgt_canonical: Column, iou: Column, depth_pred: Column, depth_obs: Column, visible: Column) -> Column:
    """One line on a match: its number, both labels, whether their identities are the same but for capitals, IoU and depths.

    Fixed values: the line's format.
    """
    a, b = identity(src_canonical, src_label), identity(tgt_canonical, tgt_label)
    sign = F.when(F.lower(a) == F.lower(b), "=").otherwise("≠")
    mark = F.when(visible, "✓").otherwise("✗OCC")
    return F.format_string("[%d] '%s' %s '%s' | iou=%.2f Δd=%+.2fm (pred %.2f vs obs %.2f) %s", idx, shown(src_label, a), sign, shown(tgt_label, b), iou, depth_pred - depth_obs, depth_pred, depth_obs, mark)


def slot(key: Column, n: int = 20) -> Column:
    """A number below n that follows from the key alone."""
    return F.pmod(F.conv(F.substring(F.sha1(key), 1, 8), 16, 10).cast("long"), F.lit(n))


def pair_seed(seed: int, scene: Column, src: Column, tgt: Column) -> Column:
    """The number that a pair's random draws begin with."""
    key = F.concat(scene, F.lit(":"), src, F.lit("->"), tgt)
    return F.conv(F.substring(F.sha1(key), 1, 8), 16, 10).cast("long").bitwiseXOR(F.lit(seed).cast("long"))


def in_order(x: Column, kind: DataType) -> Column:
    """x with the fields of its structs, at any depth, in the order of their names."""
    if isinstance(kind, StructType):
        parts = F.struct(*[in_order(x[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(x.isNotNull(), parts)
    return F.transform(x, lambda y: in_order(y, kind.elementType)) if isinstance(kind, ArrayType) else x


def spaced_json(x: Column) -> Column:
    """JSON with a space after each comma and colon outside strings, and with characters beyond ASCII escaped.

    Every match begins where the last one ended and takes strings whole, so nothing within a string is touched.
    """
    spaced = F.regexp_replace(F.to_json(x, {"ignoreNullFields": "false"}), r'\G((?:"(?:[^"\\]|\\.)*+"|[^",:])*+)([,:])', "$1$2 ")

    def escaped(c: Column) -> Column:
        n = F.ascii(c)
        high, low = 55296 + F.floor((n - 65536) / 1024), 56320 + (n - 65536) % 1024
        return F.when(n < 128, c).when(n < 65536, F.format_string("\\u%04x", n)).otherwise(F.format_string("\\u%04x\\u%04x", high.cast("int"), low.cast("int")))

    plain = F.array_join(F.transform(F.split(spaced, ""), escaped), "")
    return F.when(spaced.rlike(r"[^\x00-\x7f]"), plain).otherwise(spaced)


def signature(evidence: Column, kind: StructType | None = None) -> Column:
    """Ten characters that stand for evidence, a struct; kind is its type, so that its fields can be put in order."""
    return F.substring(F.sha1(spaced_json(evidence if kind is None else in_order(evidence, kind))), 1, 10)


def cache_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def codes(skills: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return F.array_join(F.transform(F.array_sort(F.array_distinct(skills)), lambda s: F.coalesce(F.try_element_at(names, s), F.substring(s, 1, 3))), ",")


def data_url(path: Column, content: Column) -> Column:
    """An image as a data URL; the type follows from the name's ending."""
    kind = F.lower(F.regexp_extract(path, r"\.([A-Za-z]+)$", 1))
    return F.concat(F.lit("data:image/"), F.when(kind == "jpg", "jpeg").when(kind == "", "png").otherwise(kind), F.lit(";base64,"), F.base64(content))


def lines(rows: Column, line) -> Column:
    """The first five rows as lines."""
    return F.array_join(F.transform(F.slice(F.coalesce(rows, F.slice(rows, 1, 0)), 1, 5), lambda r: F.concat(F.lit("  - "), line(r))), "\n")


def known(x: Column, otherwise: str = "?") -> Column:
    return F.coalesce(x.cast("string"), F.lit(otherwise))


def number(x: Column, form: str) -> Column:
    return F.format_string(form, F.coalesce(x.cast("double"), F.lit(0.0)))


def many(rows: Column) -> Column:
    return F.greatest(F.lit(0), F.coalesce(F.size(rows), F.lit(0))).cast("string")


def questions(e: Column) -> dict[str, list]:
    """What a verifier is asked of each skill's evidence, a struct with the fields of skills.EVIDENCE: what was found, then the question."""
    farthest = F.get(F.filter(e["candidates"], lambda c: c["match_idx"] == e["farthest_match_idx"]), F.lit(0))["label"]
    return {
        "anchor": [
            "ANCHOR. Found in both views: ", many(e["shared_objects"]), " object(s)\n", lines(e["shared_objects"], lambda o: F.concat(known(o["src_label"]), F.lit(", size x"), number(o["scale_ratio"], "%.2f"))),
            "\nIs each of them one and the same thing in both images, seen from clearly different places?",
        ],
        "counting": [
            "COUNTING. Category ", known(e["category"]), ": ", known(e["unique_total"], "0"), " distinct in both images together, ", many(e["shared_match_idx"]), " in both, ", many(e["private_src_idx"]), " in image 1 only, ",
            many(e["private_tgt_idx"]), " in image 2 only.\nIs the number right, and can neither image alone give it?",
        ],
        "relative_distance": [
            "RELATIVE DISTANCE. From ", known(e["reference_label"]), " to:\n", lines(e["candidates"], lambda c: F.concat(known(c["label"]), F.lit(" "), number(c["distance_m"], "%.2f m"))),
            "\nFarthest: ", known(farthest), ", by ", number(e["margin_m"], "%.2f m"), ".\nIs the order clear, and is it plain which object the reference is?",
        ],
        "relative_direction": [
            "RELATIVE DIRECTION. Seen from image 2's camera:\n", lines(e["targets"], lambda t: F.concat(known(t["label"]), F.lit(" "), known(t["bucket"]), F.lit(" ("), number(t["azimuth_deg"], "%.0f°"), F.lit(")"))),
            "\nAre the directions right, and is each object plain to see in image 1?",
        ],
        "cross_point_correspondence": [
            "CROSS POINT CORRESPONDENCE. Labelled objects matched in both views: ", known(F.coalesce(e["n_visible_labeled"], F.size(e["qualifying_matches"])), "0"),
            ".\nAre some of them truly the same thing in both images, from clearly different places?",
        ],
        "cross_object_correspondence": [
            "CROSS OBJECT CORRESPONDENCE. Shared objects to point at in image 2: ", many(e["shared_objects"]), "\n",
            lines(e["shared_objects"], lambda o: F.concat(known(o["tgt_label"]), F.lit(" at ["), known(F.array_join(o["point_tgt"].cast("array<string>"), ", "), ""), F.lit("]"))),
            "\nIs each of them in both images, and at that place in image 2?",
        ],
        "cross_spatial_transformation": [
            "CROSS SPATIAL TRANSFORMATION. Objects whose outline changes: ", many(e["transformed_objects"]), "\n", lines(e["transformed_objects"], lambda o: F.concat(known(o["label"]), F.lit(", size x"), number(o["scale_ratio"], "%.2f"))),
            "\nDo they look clearly different from the two places?",
        ],
        "cross_depth_variation": [
            "CROSS DEPTH VARIATION. Objects whose distance changes: ", many(e["varying_objects"]), "\n",
            lines(e["varying_objects"], lambda o: F.concat(known(o["label"]), F.lit(": "), number(o["depth_src"], "%.2f m"), F.lit(" -> "), number(o["depth_tgt"], "%.2f m"), F.lit(" ("), number(o["delta_m"], "%+.2f m"), F.lit(")"))),
            "\nIs one of these changes plain to see?",
        ],
        "cross_occlusion_visibility": [
            "CROSS OCCLUSION VISIBILITY. Of image 1's objects, ", known(e["n_visible"], "0"), " are seen in image 2 and ", known(e["n_occluded"], "0"), " are hidden behind something.\nDoes the pair clearly have both?",
        ],
    }


def prompt(skill: Column, evidence: Column, template: str = "{body}") -> Column:
    """The template with the question on a skill's evidence for `{body}`; an unknown skill raises an error."""
    out = None
    for name, parts in questions(evidence).items():
        body = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        made = F.replace(F.lit(template), F.lit("{body}"), body)
        out = F.when(skill == name, made) if out is None else out.when(skill == name, made)
    return out.otherwise(F.raise_error(F.concat(F.lit("no prompt for skill "), skill)))
