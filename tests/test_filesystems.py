import pytest

from laketally.sources.filesystems import Opener


@pytest.fixture
def opened(monkeypatch):
    """(path, prefix, URI the file system was made from) of a URI."""

    def go(uri, default_fs=""):
        seen = []
        opener = Opener(default_fs)
        monkeypatch.setattr(opener, "system", seen.append)
        _, path, prefix = opener(uri)
        return path, prefix, *seen

    return go


@pytest.mark.parametrize(
    "uri, default_fs, want",
    [
        ("/a/b c", "", ("/a/b c", "", "")),
        ("/a/b", "file:///", ("/a/b", "", "")),
        ("file:/a/b", "hdfs://nn", ("/a/b", "file:", "")),
        ("file:///a/b", "", ("/a/b", "file://", "")),
        ("hdfs://nn:8020/a/b=1", "", ("/a/b=1", "hdfs://nn:8020", "hdfs://nn:8020/")),
        ("/a/b", "hdfs://nn/", ("/a/b", "hdfs://nn", "hdfs://nn/")),
        ("hdfs:///a", "", ("/a", "hdfs://", "hdfs:///")),
        ("s3a://bucket/k/v", "", ("bucket/k/v", "s3a://", "s3://bucket")),
        ("gs://bucket/k", "", ("bucket/k", "gs://", "gs://bucket")),
        ("/k", "s3a://bucket", ("bucket/k", "s3a://", "s3://bucket")),
    ],
)
def test_uris(opened, uri, default_fs, want):
    assert opened(uri, default_fs) == want


def test_one_file_system_per_store(tmp_path):
    opener = Opener()
    assert opener(str(tmp_path))[0] is opener(f"file://{tmp_path}")[0]
