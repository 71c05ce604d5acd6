"""File stores as tasks see them, through Arrow.

Spark reads through Hadoop's file systems; byte copies and listings in tasks go
through Arrow's. An ``s3a://`` path uses the session's ``fs.s3a.*`` settings
(endpoint, keys, path style, region, TLS), so a set-up that works for Spark's
reads works for them too; without such settings the environment's credentials
are used. Other paths: local or shared mounts (``file:``), ``gs://``, and HDFS
where libhdfs is installed.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Runs in Python workers: shipped by value, so that they need no more than
# pandas and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_S3A = (
    "endpoint", "endpoint.region", "access.key", "secret.key", "session.token", "path.style.access",
    "connection.ssl.enabled",
)


def store_settings(spark) -> dict[str, str]:
    """The session's ``fs.s3a.*`` settings that Arrow has a counterpart for."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {k: conf.get(f"fs.s3a.{k}") for k in _S3A}
    return {k: v for k, v in found.items() if v}


def s3_arguments(settings: dict[str, str]) -> dict:
    """``fs.s3a.*`` settings as arguments of Arrow's S3 file system."""
    out: dict = {}
    endpoint = settings.get("endpoint")
    secure = settings.get("connection.ssl.enabled", "true").lower() != "false"
    if endpoint:
        if "://" in endpoint:
            scheme, endpoint = endpoint.split("://", 1)
            secure = scheme == "https"
        out |= {"endpoint_override": endpoint.rstrip("/"), "scheme": "https" if secure else "http"}
        # Arrow uses path style with an endpoint unless told otherwise
        out["force_virtual_addressing"] = settings.get("path.style.access", "false").lower() != "true"
    for key, name in (("access.key", "access_key"), ("secret.key", "secret_key"), ("session.token", "session_token"),
                      ("endpoint.region", "region")):
        if settings.get(key):
            out[name] = settings[key]
    return out


def open_store(uri: str, settings: dict[str, str] | None = None):
    """Arrow file system and path of a URI."""
    import pyarrow.fs as pafs

    if uri.startswith("file:"):
        path = uri[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return pafs.LocalFileSystem(), path
    if uri.startswith(("s3a://", "s3n://", "s3://")):
        rest = uri.split("://", 1)[1]
        arguments = s3_arguments(settings or {})
        return (pafs.S3FileSystem(**arguments), rest) if arguments else pafs.FileSystem.from_uri("s3://" + rest)
    return pafs.FileSystem.from_uri(uri)


def children(uri: str, settings: dict[str, str] | None = None) -> list[tuple]:
    """``(path, is_folder, bytes, modified)`` of what lies directly in the folder
    ``uri``, or of the file ``uri`` itself; names that begin with ``_`` or ``.`` are
    hidden, and a folder that is gone has nothing in it."""
    import pyarrow.fs as pafs

    fs, path = open_store(uri, settings)
    at = fs.get_file_info(path)
    if at.type == pafs.FileType.File:
        return [(uri, False, at.size, _time(at))]
    out = []
    for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
        name = f.path.rstrip("/").rsplit("/", 1)[-1]
        if not name.startswith(("_", ".")):
            folder = f.type == pafs.FileType.Directory
            out.append((f"{uri.rstrip('/')}/{name}", folder, None if folder else f.size, _time(f)))
    return out


def _time(info):
    return info.mtime.replace(tzinfo=None) if info.mtime else None
