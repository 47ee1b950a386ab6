"""Named query plans of the engine, each a function of a session and a data folder."""
