"""An adaptive context-mixing range coder of token ids, in blocks that are reset and checked on their own.

The next id is predicted by the id last seen after the same two ids (order 2) and after the same one id (order 1), each with a record of how often in a row it was right.
Whether a prediction holds is coded by a binary range coder, at a chance mixed in the logistic domain from what such records have been worth. Predictions that have hardly been
right aren't tried. An id that isn't predicted is spelled in steps of four bits at the chances of an adaptive order-0 model, four of which share a machine word; in a block with ids of more than
16 bits, the bits above these come first, as they are. The mixing weights are learned on the way.
All arithmetic is of integers, and a block's bytes don't depend on its neighbours. Any id of 32 bits can be coded.

Coding takes one step after another, some hundred instructions for each id, which neither column expressions nor array operations can do at a fair price. It is therefore two functions
of binaries on the JVM, in IdCoder.java. Their classes are compiled by the compiler that Spark itself uses for generated code, once for each application, and sent
to the executors as a jar.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from importlib.resources import files
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Ids in a block.
BLOCK = 1 << 15
_NAMES = {"quillmill_encode_ids": "quillmill.EncodeIds", "quillmill_decode_ids": "quillmill.DecodeIds"}
_loaders: dict[str, object] = {}


def _classes(spark: SparkSession):
    """The class loader of the compiled functions, which the executors have, too."""
    application = spark.sparkContext.applicationId
    if application not in _loaders:
        compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
        compiler.cook(files("quillmill.llm").joinpath("IdCoder.java").read_text())
        folder = tempfile.mkdtemp(prefix="quillmill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        jar = Path(folder) / "quillmill-id-coder.jar"
        with zipfile.ZipFile(jar, "w") as z:
            for name, code in dict(compiler.getBytecodes()).items():
                z.writestr(name.replace(".", "/") + ".class", bytes(code))
        spark.sparkContext._jsc.addJar(str(jar))
        _loaders[application] = compiler.getClassLoader()
    return _loaders[application]


def register(spark: SparkSession) -> None:
    """Make the functions known to this session."""
    loader = _classes(spark)
    binary = spark._jvm.org.apache.spark.sql.types.DataTypes.BinaryType
    for name, of in _NAMES.items():
        spark._jsparkSession.udf().register(name, loader.loadClass(of).newInstance(), binary)


def encoded(spark: SparkSession, ids: str | Column) -> Column:
    """Framed blocks of a binary of little-endian unsigned 32-bit integers; null for null."""
    register(spark)
    return F.call_function("quillmill_encode_ids", ids)


def decoded(spark: SparkSession, blocks: str | Column) -> Column:
    """The way back. A damaged block raises an error that names it."""
    register(spark)
    return F.call_function("quillmill_decode_ids", blocks)
