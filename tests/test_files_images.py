import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.catalog.png import png_bytes
from maskwright.functions import arrays
from maskwright.functions.names import is_text_file
from maskwright.operators import filetree, overlay
from maskwright.sources import files, images, palettes, storage


def save(folder, name, pixels):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(png_bytes(np.array(pixels, np.uint8)))


def test_scan_decodes_colour_and_grey(spark, tmp_path):
    save(tmp_path / "i", "a.png", [[[1, 2, 3], [250, 10, 100]]])
    save(tmp_path / "i", "b.png", [[7, 9]])
    save(tmp_path / "i", ".hidden.png", [[0]])
    save(tmp_path / "i", "c.PNG", [[0]])
    save(tmp_path / "i" / "nested", "d.png", [[0]])
    scan = images.scan_images(spark, str(tmp_path / "i"), ".png")
    rows = {r["key"]: r for r in scan.select("key", images.to_rgb(F.col("image")).alias("rgb"),
                                             images.to_grey(F.col("image")).alias("grey")).collect()}
    assert sorted(rows) == ["a", "b"]
    assert rows["a"]["rgb"] == [1, 2, 3, 250, 10, 100] and rows["b"]["rgb"] == [7, 7, 7, 9, 9, 9]
    assert rows["a"]["grey"] == [2, 92] and rows["b"]["grey"] == [7, 9]


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(80):
        save(tmp_path / "i", f"{i}.png", [[i, 2]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a task of Spark's for each file
        scan = images.scan_images(spark, str(tmp_path / "i"), ".png")
        listed = files.list_folder(spark, str(tmp_path / "i"), ".png")
        few = min(2 * spark.sparkContext.defaultParallelism, 79)
        assert scan.rdd.getNumPartitions() <= few and listed.rdd.getNumPartitions() <= few
        assert sorted(r["key"] for r in scan.select("key").collect()) == sorted(map(str, range(80)))
        assert listed.count() == 80
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert storage.folder_size(str(tmp_path / "i"), ".png")[0] == 80
    assert storage.folder_size(str(tmp_path / "*"), ".png") is None


def test_pairs_are_joined_by_stem(spark, tmp_path):
    for name in "abc":
        save(tmp_path / "i", f"{name}.png", np.full((2, 2, 3), ord(name)))
    for name in "bcd":
        save(tmp_path / "m", f"{name}.png", np.full((2, 2), ord(name) - 97))
    pairs = images.load_pairs(spark, str(tmp_path / "i"), str(tmp_path / "m"), ".png", ".png").collect()
    got = {r["key"]: (r["image"][0], r["label"], r["image_shape"], r["label_shape"]) for r in pairs}
    assert got == {k: (float(ord(k)), [float(ord(k) - 97)] * 4, [2, 2, 3], [2, 2]) for k in "bc"}


def test_a_broken_image_fails_the_scan(spark, tmp_path):
    save(tmp_path / "i", "a.png", [[1]])
    (tmp_path / "i" / "b.png").write_bytes(b"not an image")
    with pytest.raises(Exception, match="not an image"):
        images.scan_images(spark, str(tmp_path / "i"), ".png").collect()


def test_payload_table(spark, tmp_path):
    spark.createDataFrame([((bytearray(range(12)), "x/a.raw"), (bytearray([1, 2, 3, 1]), "x/a.raw"))],
                          "pixel_values struct<bytes:binary,path:string>, label struct<bytes:binary,path:string>"
                          ).write.parquet(str(tmp_path / "t"))
    row = images.scan_payloads(spark, str(tmp_path / "t"), shape=(2, 2)).first()
    assert row["key"] == "a" and row["image"] == list(range(12)) and row["label"] == [1, 2, 3, 1]
    assert images.scan_payloads(spark, str(tmp_path / "t")).columns == ["pixel_values", "label"]


def test_tree_round_trip(spark, tmp_path):
    root = str(tmp_path / "tree")
    rows = [(".gitattributes", b"*"), ("_x", b"u"), ("a.txt", b"one"), ("b/c.bin", b"\x00\xff"), ("b/d/e.py", b"")]
    files.write_tree(spark.createDataFrame(rows, "path string, content binary"), root)
    assert sorted((r["path"], bytes(r["content"])) for r in files.read_tree(spark, root).collect()) == rows
    listed = files.list_folder(spark, root, ".txt").collect()
    assert len(listed) == 1 and listed[0]["length"] == 3
    with pytest.raises(Exception, match="leaves the tree"):
        files.write_tree(spark.createDataFrame([("../x", b"")], "path string, content binary"), root)
    assert {p.name for p in (tmp_path / "tree").rglob(".*")} == {".gitattributes"}


@pytest.mark.parametrize("text", ["# names\n[0, 10, 146]\n[38, 0, 44]\n[255, 232, 0]",
                                  "[0, 10, 146]\n[38, 0, 44] # second\n[38, 0, 44]\n[255, 232, 0]\n"])
def test_palette_file(spark, tmp_path, text):
    (tmp_path / "palette.txt").write_text(text)
    palette = palettes.read_palette(spark, str(tmp_path / "palette.txt"))
    assert palettes.colours_of(palette) == palettes.PETS


def test_palette_sizes():
    assert len(palettes.PETS) == 3 and len(palettes.SIDEWALKS) == 35


def test_overlay_saturates_and_the_plain_form_does_not(spark):
    df = spark.createDataFrame([([0.0, 0.5, 1.0, 0.2, 0.2, 0.2], [1, 9])], "image array<float>, mask array<int>")
    palette = palettes.palette_table(spark, palettes.PETS)
    scaled = overlay.with_overlay(df, "image", "mask", palette).first()["overlay"]
    assert scaled == [255, 63, 255, 25, 25, 25]
    plain = overlay.with_overlay(df, "image", "mask", palette, scaled=False).first()["overlay"]
    assert plain == [19, 0, 22, 0, 0, 0]


def test_mask_colours_keep_unknown_classes(spark):
    df = spark.createDataFrame([(1, [2, 7])], "k int, mask array<int>")
    rows = overlay.mask_colours(df, "k", "mask", palettes.palette_table(spark, palettes.PETS)).orderBy("px").collect()
    assert [(r["r"], r["g"], r["b"]) for r in rows] == [(255, 232, 0), (0, 0, 0)]


@pytest.mark.parametrize("path,text", [
    ("a/b.py", True), ("b.txt", True), ("b.TXT", True), ("x.html", True), ("x.csv", True), ("x.txt.gz", True),
    ("x.json", False), ("x.png", False), ("noext", False), (".txt", False), ("a.txt/b", False), ("x.", False),
    ("..txt", False), ("x.tar.gz", False)])
def test_text_files(spark, path, text):
    assert spark.createDataFrame([(path,)], "p string").select(is_text_file(F.col("p"))).first()[0] is text


def test_replacement_is_sequential_literal_and_for_text_only(spark):
    values = filetree.placeholder_values("id-$MODEL_VERSION", "url.*", "v1")
    rows = [("a.py", "$MODEL_REPO_ID $MODEL_REPO_URL $MODEL_VERSION $OTHER"), ("a.bin", "$MODEL_VERSION")]
    df = spark.createDataFrame(rows, "path string, content string")
    got = {r["path"]: r["content"] for r in filetree.replace_placeholders(df, values).collect()}
    assert got == {"a.py": "id-v1 url.* v1 $OTHER", "a.bin": "$MODEL_VERSION"}
    binary = df.withColumn("content", F.encode("content", "UTF-8"))
    got = {r["path"]: bytes(r["content"]) for r in filetree.replace_placeholders(binary, values).collect()}
    assert got["a.py"] == b"id-v1 url.* v1 $OTHER"


def test_custom_placeholders_must_be_complete():
    custom = {"MODEL_REPO_ID": "<id>", "MODEL_REPO_URL": "<url>", "MODEL_VERSION": "<v>"}
    assert filetree.placeholder_values("a", "b", "c", custom) == {"<id>": "a", "<url>": "b", "<v>": "c"}
    with pytest.raises(ValueError, match="MODEL_VERSION"):
        filetree.placeholder_values("a", "b", "c", {"MODEL_REPO_ID": "x", "MODEL_REPO_URL": "y"})


def test_sync_keeps_retained_names_unless_they_are_brought(spark):
    kind = "path string, content string"
    old = spark.createDataFrame([(".git/a", "o"), (".gitattributes", "o"), ("app/x", "o"), (".github/y", "o")], kind)
    new = spark.createDataFrame([("app/z", "n")], kind)
    assert {r["path"] for r in filetree.sync(old, new).collect()} == {".git/a", ".gitattributes", "app/z"}
    new = spark.createDataFrame([(".git/b", "n")], kind)
    assert {(r["path"], r["content"]) for r in filetree.sync(old, new).collect()} == {
        (".git/b", "n"), (".gitattributes", "o")}


def test_mask_resize_gives_fractional_classes(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 3.0], [2, 2])], "x array<float>, s array<bigint>")
    assert df.select(arrays.resize(F.col("x"), F.col("s"), 1, 1)).first()[0] == [2.5]


def test_jpeg_files_decode_with_small_loss(spark, tmp_path):
    jvm = spark.sparkContext._jvm
    (tmp_path / "i").mkdir()
    (tmp_path / "m").mkdir()
    picture = jvm.java.awt.image.BufferedImage(16, 8, jvm.java.awt.image.BufferedImage.TYPE_INT_RGB)
    for x in range(16):
        for y in range(8):
            picture.setRGB(x, y, (200 << 16) | (100 << 8) | 30)
    jvm.javax.imageio.ImageIO.write(picture, "jpg", jvm.java.io.File(str(tmp_path / "i" / "cat.jpg")))
    save(tmp_path / "m", "cat.png", np.ones((8, 16)))
    row = images.load_pairs(spark, str(tmp_path / "i"), str(tmp_path / "m")).first()
    assert row["key"] == "cat" and row["image_shape"] == [8, 16, 3] and row["label"] == [1.0] * 128
    assert np.abs(np.array(row["image"]).reshape(-1, 3) - [200, 100, 30]).max() <= 4


def test_paths_as_spark_writes_them(tmp_path):
    (tmp_path / "a.txt").write_text("x")
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        system, inner = storage.open_path(path)
        assert system.get_file_info(f"{inner}/a.txt").size == 1
        assert [size for _, size in storage.list_files(f"{path}/*.txt")] == [1]
        assert storage.walk(path) == [("a.txt", 1)]
    assert storage.pack([("a", 0), ("b", 5), ("c", 6), ("d", 20)], 10) == [["a", "b"], ["c"], ["d"]]
    assert storage.pack([], 10) == []


def test_a_failed_write_leaves_nothing(tmp_path):
    with pytest.raises(RuntimeError):
        with storage.replacing(str(tmp_path), "x/y.bin") as stream:
            stream.write(b"half")
            raise RuntimeError("lost")
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]
