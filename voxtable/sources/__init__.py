"""Reading and writing documents; frames, samples and models come in through `media`."""
