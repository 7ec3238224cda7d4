"""Registered queries of the corpus operators and, where SQL can say them, their SQL."""

from __future__ import annotations

from reviewloom.llm.multiindex import op4_inverted_multi_index
from reviewloom.llm.outliers import op3_robust_outliers
from reviewloom.llm.packing import op5_bounded_packing
from reviewloom.llm.periodic import op13_periodic_runs
from reviewloom.llm.pieces import op10_piece_lattice
from reviewloom.llm.prefixtrie import ORACLE_SQL as PREFIX_TRIE_SQL
from reviewloom.llm.prefixtrie import op11_prefix_trie
from reviewloom.llm.sharding import op1_sampled_splitters
from reviewloom.llm.simhash import op7_simhash_bk_trees
from reviewloom.llm.sitequality import op8_site_bayes
from reviewloom.llm.substrings import op6_seed_extend
from reviewloom.llm.toxicity import op2_noisy_or_toxicity
from reviewloom.llm.transducer import op12_token_transducer
from reviewloom.llm.urlrules import op9_url_association_rules

QUERIES = {
    f.__name__: f
    for f in (
        op1_sampled_splitters,
        op2_noisy_or_toxicity,
        op3_robust_outliers,
        op4_inverted_multi_index,
        op5_bounded_packing,
        op6_seed_extend,
        op7_simhash_bk_trees,
        op8_site_bayes,
        op9_url_association_rules,
        op10_piece_lattice,
        op11_prefix_trie,
        op12_token_transducer,
        op13_periodic_runs,
    )
}
ORACLE: dict[str, str] = {"op11_prefix_trie": PREFIX_TRIE_SQL}

# Windows of 35 words by text; fit for small tables, as each window is spelled out.
ORACLE["op6_seed_extend"] = r"""with texts as (
  select row_number() over () as row_id, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
placed as (select row_id, unnest(words) as word, unnest(range(len(words))) as place, len(words) as n from texts),
windows as (
  select row_id, place, n, string_agg(word, ' ') over (
    partition by row_id order by place rows between current row and 34 following) as window_text from placed),
starts as (select row_id, place, sha256(window_text) as h from windows where place <= n - 35),
repeated as (select row_id, place from starts where h in (select h from starts group by h having count(*) > 1)),
gone as (select distinct row_id, place + unnest(range(35)) as place from repeated),
kept as (
  select row_id, count(*) as n_kept, string_agg(word, ' ' order by place) as kept
  from placed p where not exists (select 1 from gone g where g.row_id = p.row_id and g.place = p.place)
  group by row_id)
select doc_id, len(words) as n_words, len(words) - coalesce(n_kept, 0) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from texts left join kept using (row_id)"""
