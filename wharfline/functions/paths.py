"""Path, prefix and folder expressions over ``/``-separated keys.

Arguments named ``prefix``, ``base`` and ``dest`` may be columns or plain
strings; plain strings become literals that Spark folds away.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wharfline.functions.text import col, strip

# Fixed values.
SCHEME = "s3://"
GZ = ".gz"
NAME_CHARS = 30
TREE_INDENT = "    "
TREE_MARK = "|-- "


def _value(x: Column | str) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def _rstrip(c: Column, ch: str = "/") -> Column:
    return F.rtrim(c, F.lit(ch))


def _lstrip(c: Column, ch: str = "/") -> Column:
    return F.ltrim(c, F.lit(ch))


def _from(c: Column, start: Column) -> Column:
    """Characters of ``c`` from the 1-based position ``start`` on."""
    return F.substr(c, start)


def as_folder(c: Column | str) -> Column:
    """'' stays '', anything else gets exactly one trailing slash."""
    bare = _rstrip(_value(c))
    return F.when(bare == "", F.lit("")).otherwise(F.concat(bare, F.lit("/")))


def _head(p: Column) -> Column:
    return F.substring_index(p, "/", 1)


def _tail(p: Column) -> Column:
    at = F.instr(p, "/")
    return F.when(at > 0, _from(p, at + 1)).otherwise(F.lit(""))


def split_bucket(path: Column | str) -> Column:
    """``bucket/key`` as struct(bucket, key), no scheme handling."""
    p = col(path)
    return F.struct(_head(p).alias("bucket"), _tail(p).alias("key"))


def split_uri(uri: Column | str) -> Column:
    """URI as struct(bucket, key): trimmed, first scheme mark removed, and no
    slashes in front of the key."""
    raw = strip(uri)
    at = F.instr(raw, SCHEME)
    bare = F.when(
        at > 0,
        F.concat(F.substr(raw, F.lit(1), at - 1), _from(raw, at + len(SCHEME))),
    ).otherwise(raw)
    return F.struct(_head(bare).alias("bucket"), _lstrip(_tail(bare)).alias("key"))


def split_bucket_prefix(bucket: Column | str, prefix: Column | str = "") -> Column:
    """struct(bucket, prefix) from one argument such as ``b/some/prefix``.

    The bucket is split only when no prefix is given; the prefix found that way
    ends with a slash unless it is empty.
    """
    b, p = col(bucket), _value(prefix)
    found = _tail(b)
    closed = F.when((found == "") | F.endswith(found, F.lit("/")), found).otherwise(
        F.concat(found, F.lit("/"))
    )
    split = (F.instr(b, "/") > 0) & (p == "")
    return F.struct(
        F.when(split, _head(b)).otherwise(b).alias("bucket"),
        F.when(split, closed).otherwise(p).alias("prefix"),
    )


def under(key: Column | str, prefix: Column | str) -> Column:
    """True for keys below ``prefix``; ``in`` does not take in ``in2/``."""
    return F.startswith(col(key), as_folder(prefix))


def ancestors(key: Column | str) -> Column:
    """array of what a prefix of folders above a key can be: '' and each leading part that ends in a slash."""
    parts = F.split(col(key), "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.when(i == 1, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), i - 1), "/"), F.lit("/"))),
    )


def relative(key: Column | str, prefix: Column | str) -> Column:
    """The key without its prefix and the slashes that follow it."""
    k, bare = col(key), _rstrip(_value(prefix))
    return F.when(bare == "", k).otherwise(_lstrip(_from(k, F.length(bare) + 1)))


def rebase(
    key: Column | str,
    prefix: Column | str,
    base: Column | str,
    dest: Column | str,
) -> Column:
    """Where a key below ``prefix`` lands below ``dest``.

    The source prefix is kept as a sub-folder, shortened by ``base`` when it
    is ``base`` itself or lies below it.
    """
    bare, root = _rstrip(_value(prefix)), _rstrip(_value(base))
    inside = (root != "") & ((bare == root) | F.startswith(bare, F.concat(root, F.lit("/"))))
    sub = F.when(inside, _lstrip(_from(bare, F.length(root) + 1))).otherwise(bare)
    return F.concat(as_folder(dest), as_folder(sub), relative(key, prefix))


def is_gz(path: Column | str) -> Column:
    return F.endswith(col(path), F.lit(GZ))


def drop_gz_suffix(path: Column | str) -> Column:
    """Remove one ``.gz`` at the end."""
    p = col(path)
    return F.when(is_gz(p), F.left(p, F.length(p) - len(GZ))).otherwise(p)


def drop_gz_everywhere(path: Column | str) -> Column:
    """Remove every ``.gz`` in the key, in folder names as well."""
    return F.replace(col(path), F.lit(GZ), F.lit(""))


def target_key(rel: Column | str, prefix: Column | str = "") -> Column:
    """Destination key of a relative path below an optional prefix."""
    bare = _rstrip(_value(prefix))
    r = col(rel)
    joined = F.when(bare == "", r).otherwise(F.concat(bare, F.lit("/"), r))
    return F.replace(joined, F.lit("\\"), F.lit("/"))


def base_name(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def display_name(path: Column | str) -> Column:
    """File name cut to the width of a progress line."""
    return F.left(base_name(path), F.lit(NAME_CHARS))


def parent_folder(rel: Column | str) -> Column:
    """Path without its last segment; '' when there is no folder."""
    r = col(rel)
    return F.when(F.instr(r, "/") > 0, F.regexp_replace(r, r"/[^/]*$", "")).otherwise(F.lit(""))


def folders_up_to(path: Column | str) -> Column:
    """array of a folder path and all folders above it, top first."""
    parts = F.split(col(path), "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"),
    )


def folder_depth(path: Column | str) -> Column:
    return F.size(F.split(col(path), "/")) - 1


def tree_label(path: Column | str) -> Column:
    """One line of a tree listing."""
    return F.concat(
        F.repeat(F.lit(TREE_INDENT), folder_depth(path)), F.lit(TREE_MARK), base_name(path)
    )


def is_hidden(rel: Column | str) -> Column:
    """True when the file or any folder above it starts with a dot."""
    return F.rlike(col(rel), F.lit(r"(^|/)\."))
