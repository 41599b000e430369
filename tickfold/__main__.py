"""Command line: ``python -m tickfold --config config.yaml``.

Reads the run configuration (YAML, or JSON when PyYAML is missing), replaces
``${NAME}`` by the environment variable ``NAME`` (an unset name stays as written,
with a warning), builds a session with the configured connectors and runs the
whole pipeline (``api.TradeProcessor.run``).  Prints the output folders as JSON.

Keys: ``mysql_url``, ``mysql_user``, ``mysql_password``, ``mysql_connector_path``,
``company_info_table``, ``market_index_table``, ``mongodb_uri``, ``mongo_db``,
``mongo_collection`` (or ``documents_path`` / ``documents_format``),
``connector_packages``, ``output_path``.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import re
import sys

_VAR = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")
log = logging.getLogger("tickfold")


def substitute(value, env=None):
    """Replace every ``${NAME}`` in a string value from ``env``."""
    env = os.environ if env is None else env
    if not isinstance(value, str):
        return value

    def one(m):
        name = m.group(1)
        if name in env:
            return env[name]
        log.warning("environment variable %s is not set", name)
        return m.group(0)

    return _VAR.sub(one, value)


def load_config(path: str, env=None) -> dict:
    with open(path) as fh:
        text = fh.read()
    try:
        import yaml
        raw = yaml.safe_load(text)
    except ImportError:
        raw = json.loads(text)
    return {key: substitute(value, env) for key, value in (raw or {}).items()}


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="python -m tickfold")
    parser.add_argument("--config", default="config.yaml")
    parser.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    args = parser.parse_args(argv)
    config = load_config(args.config)
    from tickfold.api import TradeProcessor, create_spark_session
    spark = create_spark_session(config.get("mysql_connector_path"), config.get("mongodb_uri"),
                                 packages=config.get("connector_packages"), master=args.master)
    try:
        written = TradeProcessor(spark).run(config)
    finally:
        spark.stop()
    print(json.dumps(written))
    return 0


if __name__ == "__main__":
    sys.exit(main())
