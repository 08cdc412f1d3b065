import pytest

from quarrymill.llm import toxicity


@pytest.fixture(autouse=True)
def few_tasks(monkeypatch):
    """Small tables need no 32 tasks."""
    monkeypatch.setattr(toxicity, "CALIBRATION_TASKS", 2)
