import random

from millrace.llm import media as M


def marks(text):
    payload, _ = M.payload_of(text)
    times, found = M.landmarks(payload)
    return times.tobytes() + found.tobytes()


def test_short_texts_have_own_landmarks():
    rng = random.Random(5)
    texts = ["a", "A short line.", "a" * 63 + "b", "x" * 700 + "y" + "x" * 323] + ["".join(rng.choice("abcdef .é") for _ in range(rng.randrange(5, 1024))) for _ in range(300)]
    found = [marks(t) for t in texts]
    assert all(found) and len(set(found)) == len(set(texts))
    assert not any(marks(t) for t in (None, "", "a" * 64, "a" * 6400))


def test_bytes_at_former_frame_borders_count():
    text = "".join(random.Random(6).choice("abcdefghij ") for _ in range(4096))
    for at in (0, 1023, 1024, 2048, 4095):
        changed = text[: max(0, at - 8)] + "#" * 16 + text[max(0, at - 8) + 16 :]
        assert marks(changed[:4096]) != marks(text)


def test_blocks_do_not_change_peaks(monkeypatch):
    payload, _ = M.payload_of("some longer text, told in blocks. " * 400)
    want = M.peaks_of(payload)
    monkeypatch.setattr(M, "BLOCK", 5)
    assert (M.peaks_of(payload) == want).all()
