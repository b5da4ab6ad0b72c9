"""Class names, paths, tags and log lines as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that stand for no class.
NULL_LIKE = ("", "none", "null", "nil", "nan", "void", "ignore", "ignored", "unlabeled", "unlabelled", "未标注", "无标签")


def fold(name: Column) -> Column:
    """Lower case without outer blanks; for names that are not ASCII, fold_unicode."""
    return F.lower(F.trim(name))


def fold_unicode(name: Column) -> Column:
    """NFKC and full case folding, which have no built-in function."""

    @F.pandas_udf("string")
    def run(names: pd.Series) -> pd.Series:
        return names.map(lambda n: unicodedata.normalize("NFKC", n).casefold().strip(), na_action="ignore")

    return run(name)


def compact(folded: Column) -> Column:
    """Letters and digits of a folded name."""
    return F.regexp_replace(folded, r"(?U)[\W_]+", "")


def tail(folded: Column) -> Column:
    """A folded name without the mark of the dataset it came from."""
    return compact(F.regexp_replace(folded, r"^(?:dataset|source|data|ds)\d+[_\-\s]+", ""))


def placeholder(folded: Column) -> Column:
    return tail(folded).rlike(r"^(?:class|category|类别|类别id)\d+$")


def null_like(folded: Column) -> Column:
    return folded.isNull() | folded.isin(*NULL_LIKE)


def natural_key(name: Column) -> Column:
    """A string that sorts as the name with its numbers by value (up to 20 digits)."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), 20, "0")).otherwise(p)), "")


def tag(value: Column) -> Column:
    """Letters, digits, - and _; others become one -."""
    clean = F.regexp_replace(F.trim(value), r"[^\p{L}\p{N}_-]", "-")
    clean = F.regexp_replace(F.regexp_replace(clean, r"^[-_]+|[-_]+$", ""), "-{2,}", "-")
    return F.when(clean == "", "unknown").otherwise(clean)


def identity_tag(readable: Column, identity: Column) -> Column:
    return tag(F.concat_ws("-", tag(readable), F.substring(F.sha2(identity, 256), 1, 8)))


def last_match(text: Column, pattern: str) -> Column:
    return F.trim(F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(-1)))


def first_match(text: Column, pattern: str) -> Column:
    return F.trim(F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(1)))


def minutes(text: Column) -> Column:
    """Minutes of a duration such as 1.5 h, 20min or 3 sec; null if there is none."""
    by = r"([0-9]+(?:\.[0-9]+)?)\s*(h|hr|hrs|hour|hours|min|m|sec|s)\b"
    n, unit = F.regexp_extract(F.lower(text), by, 1).try_cast("double"), F.regexp_extract(F.lower(text), by, 2)
    return F.when(unit.startswith("h"), n * 60).when(unit.startswith("m"), n).otherwise(n / 60)


def id_list(text: Column, mapping: Column, delimiter: str = ",") -> Column:
    """Ids of a delimited list through a map, blanks skipped, in order; an unknown id is null."""
    parts = F.filter(F.transform(F.split(text, delimiter), lambda p: F.trim(p)), lambda p: p != "")
    return F.transform(parts, lambda p: F.try_element_at(mapping, p.cast("int")))


def parse_ratio(text: str, names: tuple[str, ...]) -> dict[str, float]:
    """Shares of a ratio such as 8:1:1 or 0.8/0.1/0.1, one for each name, adding up to 1."""
    import re

    values = [float(p) for p in re.split(r"[:/,\s]+", text.strip()) if p]
    if len(values) != len(names) or min(values) < 0 or sum(values) <= 0:
        raise ValueError(f"not a ratio of {len(names)} parts: {text!r}")
    return {n: v / sum(values) for n, v in zip(names, values)}


def model_short(model: Column) -> Column:
    """The last part of a model's name up to its first hyphen."""
    return F.get(F.split(F.element_at(F.split(model, "/"), -1), "-"), F.lit(0))


#: Folder names that only state a task.
TASK_FOLDERS = ("dataset", "data", "dataset_det", "dataset_cls", "dataset_seg", "data_det", "data_cls", "data_seg")


def dataset_short(path: Column) -> Column:
    """The nearest folder above a file, below any "datasets" and the root, that says more than a task, without its suffix."""
    folders = F.reverse(F.slice(F.split(path, "/"), F.lit(1), F.size(F.split(path, "/")) - 1))
    stop = F.array_min(F.transform(F.filter(F.transform(folders, lambda f, i: F.struct(i.alias("i"), F.lower(f).isin("", "datasets").alias("end"))), lambda s: s["end"]), lambda s: s["i"]))
    near = F.slice(folders, F.lit(1), F.coalesce(stop, F.size(folders)))
    told = F.transform(F.filter(near, lambda f: ~F.lower(f).isin(*TASK_FOLDERS)), lambda f: F.regexp_replace(f, "(?i)(_dataset|_data|_det|_cls|_seg)$", ""))
    return F.coalesce(F.get(F.filter(told, lambda f: f != ""), F.lit(0)), F.lit("dataset"))


def filled(name: Column, class_id: Column) -> Column:
    """A class name, or class_<id> where there is none."""
    return F.coalesce(name, F.concat(F.lit("class_"), class_id.cast("string")))
