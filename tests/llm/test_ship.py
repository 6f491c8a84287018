"""The package is sent only where workers would not find it."""

from __future__ import annotations

import zipfile

from marginlab.llm import ship


class Context:
    def __init__(self, name):
        self.applicationId, self.sent = name, []

    def addPyFile(self, path):
        self.sent.append(path)


class Session:
    def __init__(self, name):
        self.sparkContext = Context(name)


def test_sent_once_where_it_is_needed(monkeypatch, tmp_path):
    session = Session("app-1")
    monkeypatch.chdir(tmp_path)
    monkeypatch.setenv("PYTHONPATH", f"{tmp_path}")
    ship.ship(session)
    ship.ship(session)
    assert len(session.sparkContext.sent) == 1
    assert "marginlab/llm/pieces.py" in zipfile.ZipFile(session.sparkContext.sent[0]).namelist()


def test_not_sent_where_it_is_found(monkeypatch):
    session = Session("app-2")
    monkeypatch.setenv("PYTHONPATH", str(ship.Path(ship.__file__).resolve().parents[2]))
    ship.ship(session)
    assert session.sparkContext.sent == []
