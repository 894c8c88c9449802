"""The library without its training-text package: the entry imports, and all library queries are there."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

from isograd.plans.oracles import ORACLES
from isograd.plans.queries import QUERIES

SAY = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_package(tmp_path, pipeline):
    shutil.copytree(f"{ROOT}/isograd", tmp_path / "isograd", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline and os.path.exists(f"{ROOT}/corpus_pipeline.py") else [])]:
        shutil.copy(f"{ROOT}/{name}", tmp_path)
    env = {**os.environ, "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    found, twins = out.stdout.splitlines()
    assert found.split() == sorted(QUERIES) and twins.split() == sorted(ORACLES)


def test_a_broken_package_is_not_hidden(tmp_path):
    """Only a missing package is passed over; an error inside it is raised."""
    shutil.copytree(f"{ROOT}/isograd", tmp_path / "isograd", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "isograd/llm").mkdir()
    (tmp_path / "isograd/llm/__init__.py").write_text("import not_installed_here\n")
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    env = {**os.environ, "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, env=env, capture_output=True, text=True, check=False)
    assert out.returncode and "not_installed_here" in out.stderr


def test_names_of_test_modules_differ():
    """Equal names in two folders would keep one module from being collected."""
    names = [f for _, _, files in os.walk(f"{ROOT}/tests") for f in files if f.endswith(".py") and f != "__init__.py"]
    assert len(names) == len(set(names))
