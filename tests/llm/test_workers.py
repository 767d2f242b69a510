import pyarrow as pa

from lexispan.llm import workers
from lexispan.llm.workers import lean


def test_memory_goes_back_after_the_last_batch_only(monkeypatch):
    events = []
    monkeypatch.setattr(workers, "give_back", lambda: events.append("back"))

    def work(batches):
        for batch in batches:
            events.append(batch.num_rows)
            yield batch

    batches = [pa.record_batch({"x": [1] * n}) for n in (2, 3)]
    assert list(lean(work)(iter(batches))) == batches
    assert events == [2, 3, "back"]


def test_memory_goes_back_after_an_error(monkeypatch):
    events = []
    monkeypatch.setattr(workers, "give_back", lambda: events.append("back"))

    def work(batches):
        yield next(batches)
        raise ValueError("broken")

    caught = None
    try:
        list(lean(work)(iter([pa.record_batch({"x": [1]})])))
    except ValueError as error:
        caught = error
    assert str(caught) == "broken" and events == ["back"]


def test_giving_back_is_harmless():
    workers.give_back()
