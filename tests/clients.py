"""Stand-ins for models and validators, given to commands as ``clients:name``."""


def instructions():
    return lambda text, attempt: (f"Ask about {text[:10]}", None)


def backend():
    return lambda messages, settings: [{"prediction": "p" * len(m[0]["content"]), "prompt_tokens": 3, "completion_tokens": settings["max_new_tokens"] if len(m[0]["content"]) > 5 and "repetition_penalty" not in settings else 2, "latency_seconds": 0.5, "finished_eos": None} for m in messages]


def failing():
    def call(messages, settings):
        raise OSError("no device")

    return call


def judge():
    return lambda row: '{"correctness": 4, "completeness": 2, "rationale": "fine"}'


def validator():
    def tool(files):
        bad = [n for n, c in files if "RUN b" in c]
        return (1 if bad else 0), "\n".join(bad)

    return tool, lambda output: [(n, "rejected") for n in output.splitlines() if n]
