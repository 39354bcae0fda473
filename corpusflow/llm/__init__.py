"""Training-data operators. Each module holds one operator with its own general interface;
``queries`` and ``oracle`` register them. Nothing else in the package imports this folder."""
