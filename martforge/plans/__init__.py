"""The report and dimension marts; each is ``build(src: Sources, cfg: MartConfig) -> DataFrame``."""
