import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from auditlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "auditlake-tests",
        **{
            # Tiny inputs: plan time is everything, so no adaptive stages and little code generation.
            "spark.sql.shuffle.partitions": "2",
            "spark.sql.adaptive.enabled": "false",
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.ui.enabled": "false",
            "spark.log.level": "ERROR",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    # The queries run later in the session under production settings; tests reset them here.
    yield session
    session.stop()
