"""Registered queries of this subpackage and their SQL counterparts."""

from .alignment import op13_alignment
from .embedding_join import OP1_SQL, op1_embedding_join
from .extraction import op12_extraction
from .language import op10_language
from .lexical import OP11_SQL, op11_lexical
from .licences import op5_licences
from .minhash import OP2_SQL, op2_minhash
from .mixing import op6_mixing
from .neighbours import op9_neighbours
from .packing import op8_packing
from .quality import op3_quality
from .sharding import op4_sharding
from .warc import OP7_SQL, op7_warc

QUERIES = {
    "op1_embedding_join": op1_embedding_join,
    "op2_minhash": op2_minhash,
    "op3_quality": op3_quality,
    "op4_sharding": op4_sharding,
    "op5_licences": op5_licences,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_packing": op8_packing,
    "op9_neighbours": op9_neighbours,
    "op10_language": op10_language,
    "op11_lexical": op11_lexical,
    "op12_extraction": op12_extraction,
    "op13_alignment": op13_alignment,
}

ORACLES = {"op1_embedding_join": OP1_SQL, "op2_minhash": OP2_SQL, "op7_warc": OP7_SQL, "op11_lexical": OP11_SQL}
