"""The corpus operators' registered queries and, where SQL can express them, their SQL."""

from fleetlens.llm.best_fit import op12_best_fit
from fleetlens.llm.decontaminate import op3_decontamination
from fleetlens.llm.html_text import op7_html_text
from fleetlens.llm.language_id import op4_language_id
from fleetlens.llm.license_scan import op8_license_scan
from fleetlens.llm.line_quality import OP2_SQL, op2_line_quality
from fleetlens.llm.packing import op1_packing
from fleetlens.llm.quality_classifier import op6_quality_classifier
from fleetlens.llm.shallot import op11_shallot_clusters
from fleetlens.llm.sharding import op10_sharding
from fleetlens.llm.simhash import op9_simhash
from fleetlens.llm.suffix_dedup import op5_suffix_dedup
from fleetlens.llm.whitening import op13_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_line_quality,
        op3_decontamination,
        op4_language_id,
        op5_suffix_dedup,
        op6_quality_classifier,
        op7_html_text,
        op8_license_scan,
        op9_simhash,
        op10_sharding,
        op11_shallot_clusters,
        op12_best_fit,
        op13_whitening,
    )
}
ORACLES = {"op2_line_quality": OP2_SQL}
