"""A completion function that the command line can name."""


def connect():
    return lambda prompt, model, temperature, max_tokens: f"{model} {temperature} {max_tokens}"
